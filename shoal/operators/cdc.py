"""Change records of the shop database: envelope checks, row selection,
field projection and the cart-add fact.

A change record is ``database, table, type, ts, data map, old map`` (plus a
``seq`` giving arrival order). All operators are column expressions and
filters; they work the same on a batch frame and on a stream.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.functions import as_int, map_get
from shoal.schemas import CHANGE_LOG

# Record types of the bootstrap markers, which carry no row.
BOOTSTRAP_TYPES = ("bootstrap-start", "bootstrap-complete")


def parse_change_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Change-topic text -> change records; text that is not an object with
    the envelope fields gives NULL fields and is dropped by
    ``filter_change_envelope``. The parse stands behind a generator, so filters
    on its fields don't repeat it."""
    carried = [c for c in raw.columns if c != value]
    return raw.select(*carried, F.inline(F.array(F.from_json(F.col(value), CHANGE_LOG))))


UNREADABLE, NO_DATA, NO_TYPE, MARKER = "unreadable", "no data", "no type", "marker"


def judge_change_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """``parse_change_log`` that keeps the text and says what is wrong with it.

    ``reason`` is NULL for records that ``filter_change_envelope`` keeps; ``unreadable`` text is
    no object with an envelope field (or NULL); bootstrap ``marker`` records carry no row and
    are nobody's fault; the others lack ``data`` or ``type``. Every row has one verdict, so
    rows in = records + markers + dead letters.
    """
    parsed = parse_change_log(raw.withColumn("__text", F.col(value)), "__text")
    nothing = F.coalesce(*[F.col(f.name).cast("string") for f in CHANGE_LOG.fields]).isNull()
    reason = F.when(nothing, UNREADABLE).when(F.col("type").isin(*BOOTSTRAP_TYPES), MARKER) \
        .when(F.col("data").isNull(), NO_DATA).when(F.col("type").isNull(), NO_TYPE)
    return parsed.withColumn("reason", reason)


def split_change_log(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(change records, dead letters) of change-topic text: the dead letters are the input's rows
    with a ``reason``; markers are in neither."""
    judged = judge_change_log(raw, value)
    records = judged.where(F.col("reason").isNull()).drop("reason", value)
    return records, judged.where(F.col("reason").isNotNull() & (F.col("reason") != MARKER)).select(*raw.columns, "reason")


def counted(judged: DataFrame, name: str, *reasons: str) -> DataFrame:
    """The same rows; their number, and how many have each of ``reasons``, are observed as ``name``
    (a stream's progress has them for each micro-batch: ``rows`` and the reasons, ``_`` for blanks)."""
    each = [F.count_if(F.col("reason") == r).alias(r.replace(" ", "_")) for r in reasons]
    return judged.observe(name, F.count(F.lit(1)).alias("rows"), *each)


def filter_change_envelope(changes: DataFrame) -> DataFrame:
    """Keep records that carry row data: ``data`` and ``type`` present and
    the type is not a bootstrap marker."""
    return changes.where(F.col("data").isNotNull() & F.col("type").isNotNull()
                         & ~F.col("type").isin(*BOOTSTRAP_TYPES))


def select_change_rows(changes: DataFrame, table: str,
                       types: Iterable[str] = ("insert",)) -> DataFrame:
    return changes.where((F.col("table") == table) & F.col("type").isin(*list(types)))


def project_change_fields(changes: DataFrame, fields: Iterable[str] | Mapping[str, str],
                          keep: Iterable[str] = ()) -> DataFrame:
    """``data['k'] AS k`` for each field (or ``data[k] AS alias`` for a
    mapping ``k -> alias``); a missing key gives NULL."""
    pairs = fields.items() if isinstance(fields, Mapping) else [(f, f) for f in fields]
    return changes.select(*[map_get("data", k).alias(a) for k, a in pairs], *keep)


def cart_add_rows(changes: DataFrame) -> DataFrame:
    """Cart additions: inserts, and updates that raise ``sku_num``. The
    quantity of an update is the increase (new - old)."""
    new, old = as_int(map_get("data", "sku_num")), as_int(map_get("old", "sku_num"))
    is_insert = F.col("type") == "insert"
    grew = ((F.col("type") == "update") & map_get("old", "sku_num").isNotNull() & (new > old))
    rows = changes.where((F.col("table") == "cart_info") & (is_insert | grew))
    delta = F.when(is_insert, map_get("data", "sku_num")).otherwise((new - old).cast("string"))
    return rows.select(
        *[map_get("data", k).alias(k) for k in
          ("id", "user_id", "sku_id", "source_type", "source_id")],
        delta.alias("sku_num"), "ts")


CART_ADD_COLUMNS = ("id", "user_id", "sku_id", "source_id", "source_type", "source_type_name",
                    "sku_num", "ts")


def cart_add(changes: DataFrame, dic: DataFrame, **lookup) -> DataFrame:
    """Cart-add fact: cart additions joined with the dictionary (inner: a
    code without a dictionary entry drops the row)."""
    from shoal.operators.joins import lookup_join
    adds = cart_add_rows(changes)
    names = dic.select(F.col("dic_code"), F.col("dic_name").alias("source_type_name"))
    return lookup_join(adds, names, "source_type", "dic_code", **lookup) \
        .select(*CART_ADD_COLUMNS)
