"""Fields that no contract declares: their types are learnt from the values, widened as more come, and the fields promoted to columns.

Raw tables keep such values as text in the map ``_undeclared``, so a type that turns out too narrow costs
nothing: it is widened, and the next reading casts the same text anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.sources.files import UNDECLARED, path_exists

_LEDGER = "field string, type string, seen bigint"
#: What holds both of two types; any other pair is text.
WIDER = {("bigint", "double"): "double"}


def widened(a: str | None, b: str | None) -> str:
    """The narrowest type that holds values of both; None holds none."""
    if a is None or b is None or a == b:
        return a or b or "string"
    return WIDER.get((a, b)) or WIDER.get((b, a)) or "string"


def _like(value: Column, kind: str) -> Column:
    """Whether a text is a value of a type as JSON writes it; so ``007`` stays text."""
    patterns = {"bigint": r"^-?(0|[1-9][0-9]{0,17})$", "double": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$", "boolean": "^(true|false)$"}
    return value.rlike(patterns[kind])


def inferred(raw: DataFrame) -> DataFrame:
    """(``field``, ``type``, ``seen``) of all undeclared fields, over all their values.

    Counts are summed in each task first, so a field of every row costs one row for each task. JSON's null
    says nothing of a type.
    """
    values = raw.select(F.explode(UNDECLARED).alias("field", "value")).filter("value IS NOT NULL")
    fits = [F.count_if(_like(F.col("value"), kind)).alias(kind) for kind in ("bigint", "double", "boolean")]
    counted = values.groupBy("field").agg(F.count("*").alias("seen"), *fits)
    kind = F.lit("string")
    for name in ("boolean", "double", "bigint"):
        kind = F.when(F.col(name) == F.col("seen"), name).otherwise(kind)
    return counted.select("field", kind.alias("type"), "seen")


class FieldLedger:
    """The undeclared fields of one raw table and the types they have had so far, as a small table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def types(self) -> dict[str, str]:
        if not path_exists(self.spark, self.path):
            return {}
        return {r["field"]: r["type"] for r in self.spark.read.schema(_LEDGER).parquet(self.path).collect()}

    def learn(self, raw: DataFrame) -> dict[str, str]:
        """Take the fields of ``raw`` (all rows, or those that are new) into the ledger; a type only ever widens."""
        known = self.types()
        found = {r["field"]: (r["type"], r["seen"]) for r in inferred(raw).collect()}
        if found:
            merged = {f: widened(known.get(f), found[f][0] if f in found else None) for f in {*known, *found}}
            lines = [(f, merged[f], found.get(f, ("", 0))[1]) for f in sorted(merged)]
            self.spark.createDataFrame(lines, _LEDGER).coalesce(1).write.mode("overwrite").parquet(self.path)
        return self.types()

    def promoted(self, raw: DataFrame) -> DataFrame:
        """``raw`` with a typed column for each known field, and without it in ``_undeclared``.

        A field of a struct (``readings.x``) becomes ``readings_x``. A value that does not fit its column,
        because it came after the last ``learn``, stays in the map, and so does a field whose column would
        clash with another one.
        """
        taken = {c.lower() for c in raw.columns}
        columns = {}
        for field, kind in sorted(self.types().items()):
            name = field.replace(".", "_")
            if name.lower() not in taken:
                taken.add(name.lower())
                columns[name] = (field, kind)
        if not columns:
            return raw
        text = {name: F.col(UNDECLARED)[field] for name, (field, _) in columns.items()}
        fits = {name: F.lit(True) if kind == "string" else _like(text[name], kind) | (_like(text[name], "bigint") if kind == "double" else F.lit(False)) for name, (_, kind) in columns.items()}
        typed = [F.when(fits[name], text[name]).try_cast(kind).alias(name) for name, (_, kind) in columns.items()]
        gone = F.array_compact(F.array(*[F.when(fits[name] & text[name].isNotNull(), F.lit(field)) for name, (field, _) in columns.items()]))
        rest = F.map_filter(UNDECLARED, lambda k, v: ~F.array_contains(gone, k))
        return raw.select(*[rest.alias(c) if c == UNDECLARED else F.col(f"`{c}`") for c in raw.columns], *typed)
