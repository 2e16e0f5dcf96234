"""Scoring of extractors against gold labels: counts by field, P/R/F1, micro average."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.functions.ratios import precision_recall_f1
from notewright.functions.text import strip
from notewright.schemas import BIOMARKER, TNM

MICRO = "MICRO-AVG"
_WHOLE = "decimal(38,0)"


def normalised(c: Column) -> Column:
    return F.lower(strip(c))


def _number(c: Column) -> Column:
    """A number as text that is equal for equal numbers of any type: whole ones by their digits,
    others as doubles."""
    double = c.cast("double")
    whole = (F.abs(double) < 1e37) & (double == F.rint(double))
    return F.concat(F.lit("n:"), F.when(whole, c.try_cast(_WHOLE).cast("string"))
                    .otherwise(double.cast("string")))


def comparable(c: Column, data_type: T.DataType) -> Column:
    """A scalar as text that is equal only for equal values.

    Strings compare trimmed and in lower case, numbers as numbers, and a string never equals
    a number. For a VARIANT the type of each value decides.
    """
    if isinstance(data_type, T.StringType):
        return F.concat(F.lit("s:"), normalised(c))
    if isinstance(data_type, T.BooleanType):
        return F.concat(F.lit("n:"), c.cast("int").cast("string"))
    if isinstance(data_type, T.VariantType):
        kind = F.schema_of_variant(c)
        exact = F.try_variant_get(c, "$", _WHOLE)
        double = F.try_variant_get(c, "$", "double")
        return (
            F.when(c.isNull() | F.is_variant_null(c), F.lit(None))
            .when(kind == "STRING",
                  F.concat(F.lit("s:"), normalised(F.try_variant_get(c, "$", "string"))))
            .when(kind == "BOOLEAN", F.concat(
                F.lit("n:"), F.try_variant_get(c, "$", "boolean").cast("int").cast("string")))
            .when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
                  F.concat(F.lit("n:"), exact.cast("string")))
            .when(double.isNotNull() & ((kind == "DOUBLE") | kind.startswith("DECIMAL")),
                  _number(double))
            .otherwise(F.concat(F.lit("j:"), F.to_json(c)))
        )
    if isinstance(data_type, T.IntegralType):
        return F.concat(F.lit("n:"), c.cast("string"))
    return _number(c)


@dataclass(frozen=True)
class ScalarField:
    """An exact match. Null on both sides is not counted; a wrong value counts twice, as a
    false positive and as a false negative."""

    name: str


@dataclass(frozen=True)
class SetField:
    """Overlap of two sets; ``items`` turns the column, of a given type, into an array of
    comparable members."""

    name: str
    items: Callable[[Column, T.DataType], Column]


_TEXT, _VARIANT = T.StringType(), T.VariantType()


def marker_items(c: Column, data_type: T.DataType) -> Column:
    """(name, status) pairs; in a VARIANT, a member that is no object is a name of its own kind."""
    if not isinstance(data_type, T.VariantType):
        return F.transform(c, lambda m: F.struct(*[
            comparable(m[part], _TEXT).alias(part) for part in BIOMARKER.fieldNames()
        ]))

    def pair(m: Column) -> Column:
        name, status = (
            comparable(F.try_variant_get(m, f"$.{part}", "variant"), _VARIANT)
            for part in BIOMARKER.fieldNames())
        is_object = F.startswith(F.schema_of_variant(m), F.lit("OBJECT"))
        return F.struct(
            F.when(is_object, name).otherwise(F.concat(F.lit("m:"), F.to_json(m))).alias("name"),
            F.when(is_object, status).alias("status"))

    return F.transform(F.try_variant_get(c, "$", "array<variant>"), pair)


def term_items(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.VariantType):
        return F.transform(F.try_variant_get(c, "$", "array<variant>"),
                           lambda m: comparable(m, _VARIANT))
    return F.transform(c, lambda m: comparable(m, _TEXT))


def stage_items(c: Column, data_type: T.DataType) -> Column:
    """The stated categories as (category, value) pairs."""
    def value(part: str) -> Column:
        if isinstance(data_type, T.VariantType):
            return comparable(F.try_variant_get(c, f"$.{part}", "variant"), _VARIANT)
        return comparable(c[part], _TEXT)

    pairs = F.array(*[
        F.struct(F.lit(part).alias("part"), value(part).alias("value"))
        for part in TNM.fieldNames()
    ])
    return F.filter(pairs, lambda pair: pair["value"].isNotNull())


FACT_FIELDS = (
    ScalarField("primary_diagnosis"),
    ScalarField("primary_site"),
    ScalarField("histology"),
    ScalarField("ecog_performance_status"),
    SetField("tnm_stage", stage_items),
    SetField("biomarkers", marker_items),
    SetField("medications", term_items),
)


def last_record_wins(records: DataFrame, key: str, order: str) -> DataFrame:
    """One record per key: the one with the highest ``order``.

    Each task keeps its own best record per key before the shuffle, so a key that repeats
    without bound sends one record per task.
    """
    kept = [c for c in records.columns if c not in (key, order)]
    return records.groupBy(key).agg(
        F.max_by(F.struct(*kept), F.col(order)).alias("_record")
    ).select(key, *[F.col("_record")[c].alias(c) for c in kept])


def keyed_once(records: DataFrame, key: str) -> DataFrame:
    """The same records, raising if a key repeats.

    Each task sends one record and a count per key, however often the key repeats, and the rows
    come out partitioned by the key, which is what the following join needs anyway.
    """
    kept = [c for c in records.columns if c != key]
    single = records.groupBy(key).agg(
        F.count(F.lit(1)).alias("_repeats"), F.any_value(F.struct(*kept)).alias("_record"))
    guarded = single.where(
        F.when(F.col("_repeats") == 1, True).otherwise(F.raise_error(F.concat(
            F.lit(f"{key} repeats and no order column says which record wins: "),
            F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")))
    return guarded.select(key, *[F.col("_record")[c].alias(c) for c in kept])


def _prepared(frame: DataFrame, key: str, fields, order: str | None, prefix: str) -> DataFrame:
    """Key and comparable columns of one side, one row per key; a record without a key raises."""
    required = F.coalesce(F.col(key), F.raise_error(F.lit(f"a record has no {key}"))).alias(key)
    names = [f.name for f in fields]
    if order is not None and order in frame.columns:
        frame = last_record_wins(frame.select(required, *names, order), key, order)
    else:
        frame = keyed_once(frame.select(required, *names), key)
    columns = []
    for i, field in enumerate(fields):
        c, kind = F.col(field.name), frame.schema[field.name].dataType
        value = (F.array_distinct(field.items(c, kind)) if isinstance(field, SetField)
                 else comparable(c, kind))
        columns.append(value.alias(f"{prefix}_{i}"))
    return frame.select(key, *columns)


def _field_counts(field, gold: Column, pred: Column) -> dict[str, Column]:
    if isinstance(field, ScalarField):
        same = F.coalesce(gold == pred, F.lit(False))
        hits = {"tp": same, "fp": pred.isNotNull() & ~same, "fn": gold.isNotNull() & ~same}
        return {k: hit.cast("int") for k, hit in hits.items()}
    gold, pred = F.coalesce(gold, F.array()), F.coalesce(pred, F.array())
    shared = F.size(F.array_intersect(gold, pred))  # both sides hold distinct members
    return {"tp": shared, "fp": F.size(pred) - shared, "fn": F.size(gold) - shared}


def count_matches(
    gold: DataFrame,
    systems: Sequence[tuple[str, DataFrame]],
    fields: Sequence[ScalarField | SetField] = FACT_FIELDS,
    key: str = "note_id",
    order: str | None = None,
) -> DataFrame:
    """True and false positives and false negatives per system and field.

    Every gold record counts: a missing prediction is an empty one, and a prediction without
    gold is ignored. Where ``order`` is given the last record of a key wins; otherwise a
    repeated key raises.

    The gold is shuffled once, whatever the number of systems: all joins are on the same key.
    All fields are summed in one aggregate of one row, unpivoted afterwards. ``touched`` is
    false for a scalar field that is null on both sides everywhere.
    """
    names = [name for name, _ in systems]
    if len(set(names)) != len(names):
        raise ValueError(f"system names repeat: {names}")
    joined = _prepared(gold, key, fields, order, "gold")
    for s, (_, frame) in enumerate(systems):
        joined = joined.join(_prepared(frame, key, fields, order, f"pred_{s}"), key, "left")
    per_row, sums, cells = {}, [F.count(F.lit(1)).alias("_gold_rows")], []
    for s, name in enumerate(names):
        for i, field in enumerate(fields):
            counts = _field_counts(field, F.col(f"gold_{i}"), F.col(f"pred_{s}_{i}"))
            for kind, column in counts.items():
                per_row[f"{kind}_{s}_{i}"] = column
                sums.append(F.coalesce(F.sum(f"{kind}_{s}_{i}"), F.lit(0))
                            .alias(f"{kind}_{s}_{i}"))
            tp, fp, fn = (F.col(f"{kind}_{s}_{i}") for kind in ("tp", "fp", "fn"))
            touched = (F.col("_gold_rows") > 0 if isinstance(field, SetField)
                       else tp + fp + fn > 0)
            cells.append(F.struct(
                F.lit(s).alias("ord"), F.lit(name).alias("system"),
                F.lit(field.name).alias("field"), touched.alias("touched"),
                tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
            ))
    totals = joined.select([c.alias(name) for name, c in per_row.items()]).agg(*sums)
    return totals.select(F.inline(F.array(*cells)))


def field_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per system and field."""
    p, r, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.where("touched").select(
        "system", "field", "tp", "fp", "fn", p.alias("p"), r.alias("r"), f1.alias("f1"))


def score_report(counts: DataFrame) -> DataFrame:
    """Field scores by name with each system's micro average last, as ``line`` orders them."""
    rolled = counts.groupingSets(
        [["ord", "system", "field"], ["ord", "system"]], "ord", "system", "field",
    ).agg(
        F.grouping("field").alias("is_total"), F.bool_or("touched").alias("touched"),
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")],
    ).where("is_total = 1 or touched")
    p, r, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    # a report has a handful of rows per system, so one window per system is small
    line = F.row_number().over(Window.partitionBy("system").orderBy("is_total", "field"))
    return rolled.select(
        "ord", "system",
        F.when(F.col("is_total") == 1, MICRO).otherwise(F.col("field")).alias("field"),
        "tp", "fp", "fn", p.alias("p"), r.alias("r"), f1.alias("f1"), line.alias("line"),
    ).orderBy("ord", "line")


def head_to_head(counts: DataFrame) -> DataFrame:
    """Systems by micro F1, best first and ties in input order; empty for a single system."""
    micro = counts.groupBy("ord", "system").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    _, _, f1 = precision_recall_f1(F.col("tp"), F.col("fp"), F.col("fn"))
    # one row per system: the whole relation is as small as the list of systems
    everyone = Window.partitionBy(F.lit(1))
    ranked = micro.select("ord", "system", f1.alias("f1")).withColumns({
        "rank": F.row_number().over(everyone.orderBy(F.desc("f1"), "ord")),
        "_systems": F.count(F.lit(1)).over(everyone),
    })
    return ranked.where("_systems > 1").select("rank", "system", "f1").orderBy("rank")
