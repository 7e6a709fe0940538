"""Paged and fan-out snapshots, replayed from saved responses; run inputs with proof of their manifest; derived partition lists.

A live source is asked elsewhere; what it answered lies in files. Here the requests that a source needs are planned from its first pages,
and saved answers are held against that plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import readers


@dataclass(frozen=True)
class Source:
    """How a source is read: ``kind`` PAGED (declared totals), FANOUT (an index and a request for each id) or FILE."""

    name: str
    kind: str
    page_size: int = 100
    max_pages: int = 10_000
    header: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    max_age_seconds: int | None = None
    options: dict = field(default_factory=dict)


class Registry(dict):
    """Sources by name."""

    def add(self, source: Source) -> Source:
        if source.kind not in ("PAGED", "FANOUT", "FILE"):
            raise ValueError(f"unknown kind: {source.kind}")
        if source.name in self:
            raise ValueError(f"source exists: {source.name}")
        self[source.name] = source
        return source

    def order(self) -> list[str]:
        """Names, each after those that it depends on."""
        done: list[str] = []

        def visit(name: str, above: tuple[str, ...]) -> None:
            if name in above:
                raise ValueError(f"sources depend on each other: {name}")
            if name not in done:
                for other in self[name].depends_on:
                    visit(other, (*above, name))
                done.append(name)

        for name in sorted(self):
            visit(name, ())
        return done

    def read(self, spark: SparkSession, name: str, path: str) -> DataFrame:
        """A FILE source's records, other sources' raw files."""
        files = readers.raw_files(spark, path)
        return readers.csv_records(files, list(self[name].header)) if self[name].kind == "FILE" else files


def planned_requests(first_pages: DataFrame, size: int, max_pages: int = 10_000) -> DataFrame:
    """(partition_id, page_no, ordinal) that a partition needs by its first answer (partition_id, declared_total).

    A total of 0 is asked twice (page 1, ordinals 0 and 1); more pages than ``max_pages`` fail the job, as cut pages would pass for all.
    """
    pages = F.greatest(F.ceil(F.col("declared_total") / size), F.lit(1))
    ok = F.when(pages > max_pages, F.raise_error(F.concat(F.lit("too many pages: "), F.col("partition_id")))).otherwise(pages).cast("int")
    d = first_pages.select("partition_id", "declared_total", F.explode(F.sequence(F.lit(1), ok)).alias("page_no"))
    turns = F.when(F.col("declared_total") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select("partition_id", "page_no", F.explode(turns).alias("ordinal"))


def missing_requests(planned: DataFrame, answers: DataFrame) -> DataFrame:
    """Planned requests without a saved answer."""
    key = ["partition_id", "page_no", "ordinal"]
    return planned.join(answers.select(*key), key, "left_anti")


def fan_out(index: DataFrame, details: DataFrame, identity: str) -> tuple[DataFrame, DataFrame]:
    """(detail rows of the index's ids, ids without a detail); an id that several pages list is asked once."""
    ids = index.select(identity).where(F.col(identity).isNotNull()).distinct()
    return details.join(ids, identity, "left_semi"), ids.join(details.select(identity), identity, "left_anti")


def run_inputs(snapshots: DataFrame, observations: DataFrame, manifest: DataFrame) -> DataFrame:
    """A run's inputs (run_id, observation_id, content_sha256, ...) if its snapshot's set of digests is the one in its manifest; else none.

    ``snapshots``: (run_id, snapshot_id); ``observations``: (snapshot_id, observation_id, content_sha256, ...); ``manifest``: (run_id, set_hash),
    the hash of the sorted ``observation_id:content_sha256``. See :func:`unproven` for the runs without proof.
    """
    inputs = snapshots.join(observations, "snapshot_id")
    return inputs.join(_proof(inputs).join(manifest, ["run_id", "set_hash"]).select("run_id"), "run_id", "left_semi")


def unproven(snapshots: DataFrame, observations: DataFrame, manifest: DataFrame) -> DataFrame:
    """(run_id, set_hash): runs of the manifest whose inputs differ from it or are missing."""
    return manifest.join(_proof(snapshots.join(observations, "snapshot_id")), ["run_id", "set_hash"], "left_anti")


def _proof(inputs: DataFrame) -> DataFrame:
    from ..functions.hashing import set_hash

    return set_hash(inputs.withColumn("_m", F.concat_ws(":", "observation_id", "content_sha256")), ["run_id"], "_m").select("run_id", "set_hash")


def derived_codes(rows: DataFrame, code: str, allowed: DataFrame | None = None, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(codes for a dependent source, sorted and once each; allowed codes that no row has)."""
    own = rows.select(F.col(code).alias("code")).where("code IS NOT NULL").distinct()
    own = own.where(F.col("code").rlike(pattern)) if pattern else own
    if allowed is None:
        return own.orderBy("code"), own.limit(0)
    wanted = allowed.select(F.col(allowed.columns[0]).alias("code")).distinct()
    return own.join(wanted, "code", "left_semi").orderBy("code"), wanted.join(own, "code", "left_anti")
