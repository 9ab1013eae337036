"""A stage as a map with failures kept apart, row by row.

One scan gives both outputs. Each row gets an ``outcome``: what the stage's
function returned, or a typed failure. ``run_stage`` writes that tagged union
once, parted by ``ok``, so that good rows and failures are read apart without
the stage running twice; counts are observed in the same pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

FAILURE = "struct<stage:string,kind:string,message:string>"
#: characters of a message that are kept, so that an error that quotes its input does not double the table
MESSAGE_CHARS = 2000


@dataclass(frozen=True)
class Stage:
    """``function`` takes the values of ``inputs`` and returns a dict of ``returns`` (a DDL struct body).

    An exception fails its row alone. Those in ``fatal`` are no fault of the row:
    they fail the task, which Spark runs again.
    """

    name: str
    inputs: tuple[str, ...]
    returns: str
    function: Callable[..., dict]
    fatal: tuple[type[BaseException], ...] = (MemoryError,)

    def outcome_type(self) -> T.StructType:
        return T.StructType.fromDDL(f"result struct<{self.returns}>, failure {FAILURE}")

    def outcome(self) -> Column:
        """struct(result, failure) of a row; exactly one of them is not null."""
        kind = to_arrow_type(self.outcome_type())
        stage = self

        @F.arrow_udf(self.outcome_type())
        def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for columns in parts:
                columns = columns if isinstance(columns, tuple) else (columns,)
                yield pa.array([stage.attempt(*(v.as_py() for v in row)) for row in zip(*columns, strict=True)], kind)

        return run(*(F.col(c) for c in self.inputs))

    def attempt(self, *values: object) -> dict:
        try:
            return {"result": self.function(*values), "failure": None}
        except self.fatal:
            raise
        except Exception as e:  # noqa: BLE001  any fault of a row is its failure
            return {"result": None, "failure": {"stage": self.name, "kind": type(e).__name__, "message": str(e)[:MESSAGE_CHARS]}}


def attempted(rows: DataFrame, stage: Stage) -> DataFrame:
    """``rows`` with ``outcome`` and ``ok``; a column of these names is replaced. The stage's function runs once a row."""
    kept = [F.col(c) for c in rows.columns if c not in ("outcome", "ok")]
    done = rows.select(*kept, stage.outcome().alias("outcome"))
    return done.withColumn("ok", F.col("outcome.failure").isNull())


@dataclass(frozen=True)
class StageRun:
    good: DataFrame
    failed: DataFrame
    counts: dict[str, int]


def run_stage(rows: DataFrame, stage: Stage, folder: str) -> StageRun:
    """Run ``stage`` over all rows and write both outputs below ``folder`` in one pass.

    ``good`` has the columns of ``rows`` and of the result (which win), ``failed``
    those of ``rows`` and stage, kind, message. A failed run leaves no ``_SUCCESS``; run
    it again with the same folder to replace what it left.
    """
    seen = Observation(f"stage {stage.name}")
    done = attempted(rows, stage).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("failed"))
    done.write.mode("overwrite").partitionBy("ok").parquet(folder)
    both = rows.sparkSession.read.schema(done.schema).parquet(folder)
    result = [f.name for f in T.StructType.fromDDL(stage.returns)]
    keys = [c for c in rows.columns if c not in ("outcome", "ok")]
    good = both.where("ok").select(*(c for c in keys if c not in result), *(F.col("outcome.result")[c].alias(c) for c in result))
    failed = both.where("not ok").select(*(c for c in keys if c not in ("stage", "kind", "message")), "outcome.failure.*")
    return StageRun(good, failed, dict(seen.get))


def unit_outcomes(done: DataFrame, unit: str, order: str, sums: tuple[str, ...], any_of: tuple[str, ...] = (), good: str = "extracted") -> DataFrame:
    """Outcome of each unit (a publication) from the attempts on its parts (documents).

    A part's failure fails its unit, with the first failure in ``order`` as
    error; other units go on. A unit without failures has the number of its
    parts and the sums and disjunctions of their results.
    """
    result = F.col("outcome.result")
    first = F.min(F.when(~F.col("ok"), F.struct(F.col(order).alias("at"), F.col("outcome.failure.kind").alias("kind"), F.col("outcome.failure.message").alias("message"))))
    per = done.groupBy(unit).agg(
        first.alias("_first"),
        F.count(F.lit(1)).alias("_parts"),
        *(F.coalesce(F.sum(result[c]), F.lit(0)).cast("long").alias(c) for c in sums),
        *(F.coalesce(F.bool_or(result[c]), F.lit(False)).alias(c) for c in any_of),
    )
    failed = F.col("_first").isNotNull()
    return per.select(
        unit,
        F.when(failed, "failed").otherwise(good).alias("status"),
        F.col("_first.kind").alias("error_kind"),
        F.col("_first.message").alias("last_error"),
        *(F.when(~failed, F.col(c)).alias(name) for c, name in (("_parts", "parts"), *((c, c) for c in (*sums, *any_of)))),
    )
