"""App-log cleaning and fan-out, without loss.

A log record is an open JSON object: only the fields the jobs act on are read
(``common.mid``, ``common.is_new``, ``page.last_page_id``, ``ts``), everything
else is carried as it came. The text is parsed once per row, behind a
generator, so that no filter repeats the parse; the record is a map from its
top-level names to ``variant`` values and every output is composed from those.

``split_dirty`` gives clean records and dirty text, ``split_log`` the five fact
outputs, and ``route_log`` all five in one pass as ``route, value`` text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTPUTS = ("error", "start", "display", "action", "page")
RECORD = "map<string,variant>"
# control columns read from a record
CONTROL = ("mid", "is_new", "last_page_id", "ts", "record")


def field(value, path: str, kind: str = "string") -> Column:
    """One field of a variant; NULL when absent or of another kind."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)


def parse_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """The input's columns and the control columns of its records.

    All control columns are NULL for text that is not a JSON object.
    """
    def read(v: Column) -> Column:
        return F.struct(
            field(v, "$.common.mid").alias("mid"),
            field(v, "$.common.is_new").alias("is_new"),
            field(v, "$.page.last_page_id").alias("last_page_id"),
            field(v, "$.ts", "bigint").alias("ts"),
            F.try_variant_get(v, "$", RECORD).alias("record"))

    # a generator keeps later filters above the parse, so it is evaluated once
    parsed = F.transform(F.array(F.try_parse_json(F.col(value))), read)
    return raw.select(*raw.columns, F.inline(parsed))


def is_clean() -> Column:
    """An object with the partition key and an event time."""
    return F.col("record").isNotNull() & F.col("mid").isNotNull() & F.col("ts").isNotNull()


def split_dirty(raw: DataFrame, value: str = "value", keep_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean records, dirty rows) of a text log.

    Dirty: NULL or empty text, text that is not a JSON object (arrays,
    scalars, broken text), and an object without ``common.mid`` or without a
    whole number in ``ts``, which the keyed jobs can't place. Fields of any other
    name and kind are carried. Other input columns are carried on both sides;
    ``keep_text`` also keeps the original text on the clean side.
    """
    parsed = parse_log(raw, value)
    carried = [c for c in raw.columns if c != value or keep_text]
    return (parsed.where(is_clean()).select(*carried, *CONTROL),
            parsed.where(~is_clean()).select(*raw.columns))


def _has(name: str) -> Column:
    """The record has this field, and not as a JSON null."""
    v = F.col("record")[name]
    return v.isNotNull() & ~F.is_variant_null(v)


def _flagged() -> Column:
    """The record with ``common.is_new`` as the control column has it now."""
    common = F.expr("try_cast(record['common'] as map<string,variant>)")
    old = field(F.col("record")["common"], "$.is_new")
    new = F.map_concat(F.map_filter(common, lambda k, v: k != "is_new"),
                       F.create_map(F.lit("is_new"), F.expr("cast(is_new as variant)")))
    rebuilt = F.map_concat(F.map_filter("record", lambda k, v: k != "common"),
                           F.create_map(F.lit("common"), F.to_variant_object(new)))
    return F.when(F.col("is_new").isNull() | old.eqNullSafe(F.col("is_new")), F.col("record")).otherwise(rebuilt)


def with_flag(log: DataFrame) -> DataFrame:
    """Records whose ``common.is_new`` follows the (repaired) control column."""
    return log.withColumn("record", _flagged())


def _without(*names: str) -> Column:
    return F.map_filter("record", lambda k, v: ~k.isin(*names))


def _elements(name: str) -> Column:
    """Elements of a list field; none when the field is absent or no list."""
    return F.coalesce(F.try_variant_get(F.col("record")[name], "$", "array<variant>"),
                      F.expr("cast(array() as array<variant>)"))


def _of(name: str, element: Column, *kept: str) -> Column:
    """``kept`` fields of the record and one list element under ``name``."""
    return F.map_concat(F.map_filter("record", lambda k, v: k.isin(*kept)), F.create_map(F.lit(name), element))


def _per_record(route: str) -> tuple[Column, Column]:
    """(condition, record) of the outputs with one row per log record.

    * ``error``: records with ``err``, whole (err, displays, actions kept);
    * ``start``: records with ``start``, without ``err``;
    * ``page``: records without ``start``, minus ``err``, ``displays``, ``actions``
      (kept even when ``page`` is absent).
    """
    return {"error": (_has("err"), F.col("record")),
            "start": (_has("start"), _without("err")),
            "page": (~_has("start"), _without("err", "displays", "actions", "start"))}[route]


# list outputs: field, name of an element, and the record's fields that go along
_PER_ELEMENT = {"display": ("displays", "display", ("common", "page", "ts")),
                "action": ("actions", "action", ("common", "page"))}


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """Five outputs of clean log records, each with its own ``record``.

    ``error``, ``start`` and ``page`` have a row per record; for records without
    ``start``, ``display`` and ``action`` have a row per element of ``displays``
    and ``actions``, with ``common`` and ``page`` (``display`` also ``ts``).
    """
    log = with_flag(log)
    carried = [c for c in log.columns if c != "record"]
    out = {}
    for route in OUTPUTS:
        if route in _PER_ELEMENT:
            source, name, kept = _PER_ELEMENT[route]
            each = log.where(~_has("start")).select(*carried, "record", F.explode(_elements(source)).alias("__e"))
            out[route] = each.select(*carried, _of(name, F.col("__e"), *kept).alias("record"))
        else:
            condition, record = _per_record(route)
            out[route] = log.where(condition).select(*carried, record.alias("record"))
    return out


def route_log(log: DataFrame) -> DataFrame:
    """All five outputs in one frame as ``(route, value)`` JSON text rows, with
    the device id as ``mid`` (the key that keeps a device's records in order).

    One ``explode`` of a small per-record array of tagged outputs: each input
    row is read once and yields its error / start / page row and its display
    and action rows. Rows of a log with ``seq`` also have a ``record_id``: that of the log
    record and the output's place in it, the same whenever the record is read again.
    """
    log = with_flag(log)

    def tagged(route: str, record: Column) -> Column:
        return F.struct(F.lit(route).alias("route"), F.to_json(record).alias("value"))

    singles = [F.when(c, tagged(r, rec)) for r, (c, rec) in ((r, _per_record(r)) for r in ("error", "start", "page"))]
    none = F.expr("cast(array() as array<struct<route:string,value:string>>)")

    def lists(route: str) -> Column:
        source, name, kept = _PER_ELEMENT[route]
        return F.when(~_has("start"), F.transform(_elements(source), lambda e: tagged(route, _of(name, e, *kept)))) \
            .otherwise(none)

    every = F.concat(F.array_compact(F.array(*singles)), lists("display"), lists("action"))
    if "seq" not in log.columns:
        return log.select("mid", F.explode(every).alias("o")).select("o.route", "mid", "o.value")
    return log.select("mid", "seq", F.posexplode(every).alias("place", "o")) \
        .select("o.route", "mid", "o.value", F.concat_ws("-", "seq", "place").alias("record_id"))
