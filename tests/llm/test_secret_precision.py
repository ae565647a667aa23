"""Ordinary runs of many forms are no secrets; random strings of as many are."""

from __future__ import annotations

import random

from tests.llm.docs import odd_docs
from tests.llm.test_text_operators import planted_tokens

from spanweave.llm import secrets

WORDS = (
    "maximum transmission unit size bytes select from where group order database connection string configuration manager user interface transaction history production environment network "
    "address translation table default value internal server response message handler library packages include upload content images thumbnail gallery article section chapter release notes version "
    "number shipping invoice customer account payment reference delivery warehouse schedule monthly report annual budget summary"
).split()
GERMAN = "donau dampf schiff fahrts gesellschaft versicherung haft pflicht rechts schutz bundes land wirtschaft minister arbeit geber verband kranken haus verwaltung strassen verkehrs ordnung".split()
NAMED = [
    "MAXIMUM_TRANSMISSION_UNIT_SIZE_BYTES", "SELECT_FROM_WHERE_GROUP_BY_X1", "/usr/local/lib/python3/site-packages/numpy/core/include", "com/wp-content/uploads/2024/05/IMG_20240501_123456", "_" * 30,
    "ISBN-978-3-16-148410-0-2024", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "Donaudampfschifffahrtsgesellschaft",
]


def ordinary(r: random.Random) -> dict[str, list[str]]:
    some = lambda k: [r.choice(WORDS) for _ in range(k)]
    day = lambda: (r.randint(1990, 2024), r.randint(1, 12), r.randint(1, 28))
    forms = {
        "constant": lambda: "_".join(some(4)).upper(),
        "path": lambda: "/" + "/".join(some(5)),
        "hyphens": lambda: "-".join(some(4)),
        "camel": lambda: "".join(x.capitalize() for x in some(4)),
        "snake": lambda: "_".join(some(4)),
        "image link": lambda: "/wp-content/uploads/{0}/{1:02d}/IMG_{0}{1:02d}{2:02d}_{3}".format(*day(), r.randint(100_000, 235_959)),
        "book number": lambda: f"ISBN-978-{r.randint(0, 9)}-{r.randint(10, 99)}-{r.randint(100_000, 999_999)}-{r.randint(0, 9)}-{day()[0]}",
        "rule": lambda: r.choice("_-=") * r.randint(20, 60),
        "compound": lambda: "".join(r.choice(GERMAN) for _ in range(4)).capitalize(),
        "numbered constant": lambda: "_".join(some(3)).upper() + f"_X{r.randint(1, 99)}",
        "dated file": lambda: "{}_{}-{:02d}-{:02d}/{}{}".format("_".join(some(2)), *day(), r.choice(WORDS), r.randint(1, 9)),
        "library": lambda: f"/usr/local/lib/python{r.randint(2, 3)}/site-packages/{r.choice(WORDS)}/{r.choice(WORDS)}/include",
    }
    return {k: [t for t in (f() for _ in range(100)) if len(t) >= secrets.LEAST_RUN] for k, f in forms.items()}


def test_ordinary_runs_of_many_forms(spark):
    r = random.Random(6)
    plain = [t for ts in ordinary(r).values() for t in ts] + NAMED
    keys = [t for ts in planted_tokens(r).values() for t in ts]
    assert len(plain) > 1000
    ratio = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = [(k, f"see {t} here") for k, t in enumerate([*plain, *keys])]
    got = {x.doc_id: any(s["k"] != 0 for s in x.spans) for x in secrets.find(odd_docs(spark, rows), ratio).collect()}
    assert sum(got[k] for k in range(len(plain))) <= 0.01 * len(plain)
    assert sum(got[k] for k in range(len(plain), len(rows))) >= 0.97 * len(keys)
    assert not any(got[k] for k in range(len(plain) - len(NAMED), len(plain)))
