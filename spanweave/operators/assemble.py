"""A training set from templates and pools: filled, noised, cleaned, checked, and written with its sidecar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.hashing import uniform
from spanweave.functions.plan import barrier
from spanweave.functions.text import DEFAULT as CLEANING
from spanweave.functions.text import CleanConfig
from spanweave.operators.clean import clean_and_project
from spanweave.operators.noise import DEFAULT, NoiseConfig, apply_noise
from spanweave.operators.records import split_valid
from spanweave.operators.templates import generate
from spanweave.sources.pools import pool_table
from spanweave.sources.records import SIDECAR, save_config, write_jsonl


def assemble(
    ids: DataFrame, templates: DataFrame, pools: DataFrame, seed: int, noise_share: float = 0.6, config: NoiseConfig = DEFAULT, cleaning: CleanConfig | None = CLEANING
) -> tuple[DataFrame, DataFrame]:
    """Sound records for ids(record_id), and broken ones with their errors (none are expected).

    A share of the records is noised; all are cleaned (unless cleaning is None); records that clean to nothing
    are not there.
    """
    made = generate(ids, templates, pools, seed).withColumn("noisy", uniform(seed + 1, F.col("record_id"), "noise") < noise_share)
    noised = apply_noise(barrier(made), seed + 1, config, only="noisy").drop("noisy")
    return split_valid(barrier(noised if cleaning is None else clean_and_project(noised, cleaning)))


def assemble_to_files(
    ids: DataFrame, tables: dict[str, DataFrame], folder: str, seed: int, noise_share: float = 0.6, config: NoiseConfig = DEFAULT, cleaning: CleanConfig | None = CLEANING
) -> str:
    """Assemble from a store's tables and write JSON lines to folder/records, and the switches of cleaning beside them.

    A broken record fails the job. Returns the path of the records.
    """
    pools = pool_table(tables["entity_pools"], tables["decoy_pools"])
    sound, broken = assemble(ids, tables["templates"], pools, seed, noise_share, config, cleaning)
    stop = F.assert_true(F.size("errors") == 0, F.concat_ws(", ", F.lit("broken record"), F.col("record_id").cast("string"), F.array_join("errors", " ")))
    checked = sound.unionByName(broken.filter(stop.isNull()).drop("errors"))
    write_jsonl(checked, f"{folder}/records")
    if cleaning is not None:
        save_config(cleaning, f"{folder}/{SIDECAR}")
    return f"{folder}/records"
