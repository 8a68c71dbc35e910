"""Personal data and the terms that give it away, with DataFrame functions only.

Base spans (e-mail addresses, IPv4 addresses, card numbers, telephone numbers) come
from patterns; where they stand follows from the lengths of a text's pieces between
matches. Patterns are written so that a long run of characters is read once.

Terms: the words of every text that holds a base value (a protected entity) are counted
with it over the whole corpus, by documents, and in how many documents each stands at all;
the words of an e-mail address itself are none of its terms.
How sure term t makes a reader of entity e is the share of t's documents that hold e, smoothed
by ``PRIOR`` documents in which e is as frequent as anywhere,
``p(e | t) = (joint + PRIOR * f(e) / N) / (f(t) + PRIOR)``. A term discloses e if that is at least
``DISCLOSURE``, at least ``CHANCE`` times what e's own frequency would give (the information
``ln(p(e | t) * N / f(e))`` is above ``ln(CHANCE)``), and t stands with e in two documents, or in the
only one that holds e. None of these moves with the size of the corpus. A disclosing term is a span
of kind ``term`` at each of its places in every text. ``sanitise`` generalises spans to their kind.

Defined results: null is the empty text; a span is counted in code points, its end
exclusive; a term that overlaps a base span is left to that span; repeated rows are
repeated; an empty table gives an empty result; other columns are kept by
``sanitise`` and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import saved

KINDS = ("email", "ip", "card", "phone")
#: The patterns, with possessive repeats and guards against starting inside a run that failed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
#: Documents of smoothing.
PRIOR = 0.5
DISCLOSURE = 0.5
CHANCE = 2
#: A term in more than one of so many documents is counted and joined by broadcast.
OFTEN = 1000


def _sql(pattern: str) -> str:
    return "r'" + pattern + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _placed(matches: str, parts: str) -> str:
    """SQL of ``array<struct<start, value>>`` from matches and the pieces between them.

    A start is a sum over all earlier pieces: of whole blocks of about the square root of
    their number, and of the pieces of its own block.
    """
    steps = f"transform({matches}, (m, i) -> length({parts}[i]) + length(m))"
    width = f"greatest(1, int(ceil(sqrt(size({matches})))))"
    sums = "transform(sequence(0, int(size(steps) div width)), b -> aggregate(slice(steps, b * width + 1, width), 0, (a, x) -> a + x))"
    begins = "transform(sums, (s, b) -> aggregate(slice(sums, 1, b), 0, (a, x) -> a + x))"
    start = (f"begins[int(i div width)] + aggregate(slice(steps, int(i div width) * width + 1, i % width), 0, (a, x) -> a + x) "
             f"+ length({parts}[i])")
    out = f"transform({matches}, (m, i) -> named_struct('start', {start}, 'value', m))"
    return _let(steps, "steps", _let(width, "width", _let(sums, "sums", _let(begins, "begins", out))))


_DIGITS = "regexp_replace({}, '[^0-9]', '')"
_LUHN = ("aggregate(sequence(1, length({d})), 0, (a, i) -> a + "
         "if(i % 2 = 0, if(int(substr({d}, length({d}) - i + 1, 1)) > 4, 2 * int(substr({d}, length({d}) - i + 1, 1)) - 9, "
         "2 * int(substr({d}, length({d}) - i + 1, 1))), int(substr({d}, length({d}) - i + 1, 1)))) % 10 = 0")
_ACCEPTS = {
    "email": "true",
    "ip": r"forall(split(x.value, r'\.'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": f"if(length({_DIGITS.format('x.value')}) between 13 and 19, {_LUHN.format(d=_DIGITS.format('x.value'))}, false)",
    "phone": f"length({_DIGITS.format('x.value')}) between 9 and 15",
}
_NEEDS = {"email": "instr(text, '@') > 0", "ip": "instr(text, '.') > 0", "card": "true", "phone": "instr(text, '+') > 0"}
_NONE = "cast(array() as array<string>)"
SPANS = "array<struct<kind:string,start:int,end:int>>"


def _with_base(docs: DataFrame) -> DataFrame:
    """Adds ``found``: the base spans with their values, by kind as listed, then start."""
    kept = docs.columns
    matched = docs.select(*kept, *[
        F.expr(f"if({_NEEDS[k]}, regexp_extract_all(text, {_sql(PATTERNS[k])}, 0), {_NONE})").alias(f"_m_{k}") for k in KINDS])
    cut = matched.select(*kept, *[F.col(f"_m_{k}") for k in KINDS], *[
        F.expr(f"if(size(_m_{k}) > 0, split(text, {_sql(PATTERNS[k])}, -1), {_NONE})").alias(f"_p_{k}") for k in KINDS])
    each = [f"transform(filter({_placed(f'_m_{k}', f'_p_{k}')}, x -> {_ACCEPTS[k]}), x -> named_struct('kind', '{k}', "
            f"'start', x.start, 'end', x.start + length(x.value), 'value', x.value))" for k in KINDS]
    return cut.select(*kept, F.expr(f"concat({', '.join(each)})").alias("found"))


_ENTITY = ("concat(s.kind, ':', if(s.kind in ('card', 'phone'), regexp_replace(s.value, '[^0-9]', ''), lower(s.value)))")


def _said(text: str) -> str:
    """SQL of the distinct terms of a text."""
    return f"array_distinct(transform(regexp_extract_all({text}, {_sql(TERM)}, 0), x -> lower(x)))"


def _reveals(joint: Column, total: Column, share: float, prior: float) -> Column:
    """Whether a term that stands ``joint`` times with an entity gives it away."""
    usual = F.col("f_e") / total
    given = (joint + prior * usual) / (F.col("f_t") + prior)
    return (given >= share) & (given >= CHANCE * usual) & (joint >= F.least(F.col("f_e"), F.lit(2)))


def disclosing(base: DataFrame, frequency: DataFrame, total: Column, share: float, prior: float) -> DataFrame:
    """The ``(entity, term)`` pairs whose term gives the entity away.

    A term stands with an entity in at most as many documents as the rarer of the two;
    what fails with that number fails with the true one and is not paired.
    """
    held = base.where("size(entities) > 0")
    values = held.select("row", F.explode("entities").alias("entity"))
    values = saved(values.join(values.groupBy("entity").agg(F.count("*").alias("f_e")), "entity"), "pii-values")
    top = values.groupBy("row").agg(F.max("f_e").alias("top"))
    said = held.select("row", "terms").join(top, "row").select("row", "top", F.explode("terms").alias("term"))
    # at most OFTEN times the mean number of terms in a document; other terms have few rows each
    often = frequency.where(F.col("f_t") > total / OFTEN)
    rare = said.join(F.broadcast(often.select("term")), "term", "left_anti") \
        .join(frequency.where(F.col("f_t") <= total / OFTEN), "term")
    counted = said.join(F.broadcast(often), "term").unionByName(rare)
    most = F.col("top") * (1 + prior / total) / share * 1.000001
    pairs = counted.where(F.col("f_t") + prior <= most).select("row", "term", "f_t").join(values, "row") \
        .where(_reveals(F.least("f_t", "f_e"), total, share, prior)) \
        .groupBy("entity", "term", "f_e", "f_t").agg(F.count("*").alias("joint"))
    return pairs.where(_reveals(F.col("joint"), total, share, prior)).select("entity", "term")


def _places(docs: DataFrame, terms: DataFrame, often: DataFrame) -> DataFrame:
    """``__span_id, __span_key, terms_at`` of every text that holds one of ``terms``: where they stand, in one pass over its words."""
    usual = often.join(terms, "term", "left_anti")
    # texts of one doc_id are told apart by a short hash where a row is only a term of one
    docs = docs.withColumn("mark", F.xxhash64("text"))
    told = docs.select("doc_id", "mark", F.explode(F.expr(_said("text"))).alias("term")) \
        .join(F.broadcast(usual), "term", "left_anti").join(terms, "term") \
        .groupBy("doc_id", "mark").agg(F.collect_set("term").alias("told")) \
        .select(F.col("doc_id").alias("__span_id"), F.col("mark").alias("__span_mark"), "told")
    marked = docs.join(told, F.col("doc_id").eqNullSafe(F.col("__span_id")) & (F.col("mark") == F.col("__span_mark"))) \
        .withColumn("words", F.expr(f"regexp_extract_all(text, {_sql(TERM)}, 0)")) \
        .withColumn("between", F.expr(f"split(text, {_sql(TERM)}, -1)"))
    places = (f"transform(filter({_placed('words', 'between')}, x -> array_contains(told, lower(x.value))), "
              "x -> named_struct('start', x.start, 'end', x.start + length(x.value)))")
    return marked.select("__span_id", F.col("key").alias("__span_key"), F.expr(places).alias("terms_at")).dropDuplicates(["__span_id", "__span_key"])


def find_spans(docs: DataFrame, share: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame:
    """``doc_id, key`` (of the text), ``base`` spans and all ``spans`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("key", F.md5(F.encode("text", "utf-8")))
    own = _said(f"regexp_replace(text, {_sql(PATTERNS['email'])}, ' ')")
    base = saved(_with_base(docs).select(
        "doc_id", "key", F.monotonically_increasing_id().alias("row"),
        F.expr("transform(found, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end))").alias("base"),
        F.expr(f"array_distinct(transform(found, s -> {_ENTITY}))").alias("entities"),
        F.expr(f"if(size(found) > 0, {own}, {_NONE})").alias("terms")), "pii-base")
    total = F.lit(float(max(base.count(), 1)))
    # counted before any join: a common term is one row of it, not one for each document
    frequency = saved(docs.select(F.explode(F.expr(_said("text"))).alias("term"))
                      .groupBy("term").agg(F.count("*").alias("f_t")), "pii-terms")
    pairs = saved(disclosing(base, frequency, total, share, prior), "pii-pairs")
    told = _places(docs, pairs.select("term").distinct(), frequency.where(F.col("f_t") > total / OFTEN).select("term"))
    out = base.join(told, F.col("doc_id").eqNullSafe(F.col("__span_id")) & (F.col("key") == F.col("__span_key")), "left")
    extra = ("transform(filter(coalesce(terms_at, cast(array() as array<struct<start:int,end:int>>)), "
             "t -> not exists(base, b -> b.start < t.end and t.start < b.end)), "
             "t -> named_struct('kind', 'term', 'start', t.start, 'end', t.end))")
    return out.select("doc_id", "key", "base", F.expr(f"concat(base, {extra})").cast(SPANS).alias("spans"))


def _written(column: str) -> Column:
    return F.expr(f"concat_ws(',', transform({column}, s -> concat(s.kind, ':', s.start, ':', s.end)))")


def report(spans: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    return spans.select("doc_id", *[F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"), _written("spans").alias("spans"))


def sanitise(docs: DataFrame, share: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame:
    """Documents with all their columns, every span generalised to ``[EMAIL]`` .. ``[TERM]``.

    Spans of different kinds may overlap: what they cover together becomes the kind of
    the span that starts first (of these, the longest).
    """
    spans = find_spans(docs, share, prior).where("size(spans) > 0").select("doc_id", "key", "spans").distinct()
    order = "array_sort(__spans, (a, b) -> case when a.start != b.start then a.start - b.start else b.end - a.end end)"
    # what stands from the end of the last span to the start of this one, then the kind
    text = (f"aggregate({order}, named_struct('at', 0, 'out', cast(array() as array<string>)), "
            "(acc, s) -> if(s.end <= acc.at, acc, named_struct('at', s.end, 'out', if(s.start < acc.at, acc.out, "
            "concat(acc.out, array(substr(text, acc.at + 1, s.start - acc.at), concat('[', upper(s.kind), ']')))))), "
            "acc -> concat(array_join(acc.out, ''), substr(text, acc.at + 1)))")
    marked = spans.select(F.col("doc_id").alias("__span_id"), F.col("key").alias("__span_key"), F.col("spans").alias("__spans"))
    key = F.md5(F.encode(F.col("text").cast("string"), "utf-8"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__span_id")) & (key == F.col("__span_key"))
    out = docs.join(marked, on, "left").withColumn("__text", F.when(
        F.col("__spans").isNull(), F.col("text")).otherwise(F.expr(text)))
    return out.select(*[F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
