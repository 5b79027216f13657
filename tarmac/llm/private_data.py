"""Personal data in texts: fixed patterns, and identifiers learnt from the words around them.

``spans`` finds e-mail addresses, network addresses, card and phone numbers by their form. These are
the seeds. What stands before and after a whole seed is a pattern: its last two words, or the word
before and the word after. Other tokens with a digit or @ in the place of a seed are
candidates; groups of digits that stand side by side are one token. Patterns and the distinct values they hold form a graph for each kind, on which scores are
passed back and forth: a pattern is worth the mean score of its values, a value as much as its
patterns together. Values of another kind count against a pattern. Candidates that patterns of
high confidence lead to are further spans of that kind; those of the fixed patterns always stay.

All of it is DataFrame expressions. Positions are code points, the end exclusive. Null texts are
empty. Rows that agree in doc_id and text get the same result; doc_id may be null. Other
columns are neither read nor changed. The expressions are written so that long runs of digits,
letters or separators take time in proportion: nothing is tried twice and nothing recurses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import saved

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the patterns; a match can only begin where one before it ended, or where
# the run of its first characters begins.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# A token with a digit or @; groups of digits with a blank between them are one, unless a mark ends the first.
DIGITS = r"[0-9][^\s\p{L}@]*+(?!\S)"
TOKEN = rf"(?:\G|(?<!\S))(?:[^\s\p{{L}}0-9@]*+{DIGITS}(?:(?<=[0-9)]) \(?{DIGITS})*+|[^\s0-9@]*+[0-9@]\S*+)"
LEAD = r"^(?:(?!\([0-9]++\))[^\p{L}0-9@+])++"

MIN_SUPPORT = 3  # distinct seeds of a kind that a pattern must hold
MIN_CONFIDENCE = 0.6
ROUNDS = 3

_FOUND = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _matches(text: Column, pattern: str, kind: int, possible: Column) -> Column:
    """All matches of a pattern with their positions, from what lies between and in them."""
    between = F.split(text, pattern, -1)
    inside = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.lit(None).cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_FOUND).alias("out"))

    def step(state: Column, x: Column) -> Column:
        at = state["at"] + F.length(x["b"])
        end = at + F.coalesce(F.length(x["m"]), F.lit(0))
        found = F.struct(at.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    pairs = F.zip_with(between, inside, lambda b, m: F.struct(b.alias("b"), F.coalesce(m, none).alias("m")))
    found = F.filter(F.aggregate(pairs, start, step, lambda s: s["out"]), lambda x: x["value"].isNotNull())
    return F.when(possible, found).otherwise(F.array().cast(_FOUND))


def spans(text: Column) -> Column:
    """The spans of the fixed patterns, by start and kind. A match that fails its test is dropped."""
    email = _matches(text, EMAIL, 0, F.contains(text, F.lit("@")))
    ip = F.filter(
        _matches(text, IP, 1, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
        lambda x: F.forall(
            F.split(x["value"], "[.]"),
            lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
            & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255),
        ),
    )
    card = F.filter(
        _matches(text, CARD, 2, text.rlike(r"[0-9](?:[ -]?[0-9]){11}")),
        lambda x: F.call_function("luhn_check", F.regexp_replace(x["value"], "[ -]", "")),
    )
    phone = F.filter(
        _matches(text, PHONE, 3, F.contains(text, F.lit("+"))),
        lambda x: F.length(F.regexp_replace(x["value"], "[^0-9]", "")).between(9, 15),
    )
    return F.array_sort(F.concat(email, ip, card, phone))


def counted(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def written(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat(F.get(names, x["kind"]), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")),
        ),
        ",",
    )


def _blanked(text: Column, found: Column) -> Column:
    """The text with the spans overwritten by as many letters."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        kept = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(x["start"] - state["at"], F.lit(0)).cast("int"))
        filled = F.greatest(x["end"] - F.greatest(x["start"], state["at"]), F.lit(0)).cast("int")
        out = F.concat(state["out"], F.array(kept, F.repeat(F.lit("x"), filled)))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(text)


def _mention(text: Column, start: Column, end: Column, value: Column, kind: Column) -> Column:
    """What stands at start..end, and the words around it without the marks that touch it."""
    before = F.substring(text, F.greatest(start - 79, F.lit(1)).cast("int"), F.least(start, F.lit(80)).cast("int"))
    after = F.substring(text, (end + 1).cast("int"), F.lit(40))
    left_words = F.split(F.regexp_replace(F.lower(before), r"[^\s\p{L}0-9]++$", ""), r"\s+")
    right_words = F.split(F.regexp_replace(F.lower(after), r"^[^\s\p{L}0-9]++", ""), r"\s+")
    left = F.concat(F.array(F.lit("^"), F.lit("^")), F.filter(left_words, lambda w: w != ""))
    right = F.filter(right_words, lambda w: w != "")
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        F.lower(value).alias("value"),
        F.concat_ws(" ", F.element_at(left, -2), F.element_at(left, -1), F.lit("_")).alias("before"),
        F.concat_ws(" ", F.element_at(left, -1), F.lit("_"), F.coalesce(F.get(right, F.lit(0)), F.lit("$"))).alias("around"),
        kind.alias("kind"),
    )


def _mentions(text: Column, found: Column) -> Column:
    """The spans found, with their kinds, and the candidates (kind -1): tokens with a digit or @ outside of
    spans, adjacent groups of digits as one, of more than 3 characters."""
    seeds = F.transform(found, lambda s: _mention(text, s["start"], s["end"], s["value"], s["kind"]))
    rest = _blanked(text, found)
    tokens = F.filter(
        _matches(rest, TOKEN, -1, rest.rlike("[0-9@]")),
        lambda x: ~F.exists(found, lambda s: (s["start"] < x["end"]) & (s["end"] > x["start"])),
    )

    def candidate(x: Column) -> Column:
        led = F.regexp_replace(x["value"], LEAD, "")
        bare = F.regexp_replace(led, r"[^\p{L}0-9]+$", "")
        start = x["start"] + F.length(x["value"]) - F.length(led)
        return _mention(text, start, start + F.length(bare), bare, F.lit(-1))

    return F.concat(seeds, F.filter(F.transform(tokens, candidate), lambda m: F.length(m["value"]) > 3))


def _key(text: str = "text") -> Column:
    return F.xxhash64(F.col(text)).alias("_text_hash")


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, the spans of the fixed patterns and the mentions; stored."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    with_base = rows.select("doc_id", _key(), "text", spans(F.col("text")).alias("base"))
    return saved(
        with_base.select("doc_id", "_text_hash", "base", _mentions(F.col("text"), F.col("base")).alias("mentions")), "spans"
    )


def confident_patterns(scans: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, pattern and confidence of the patterns that hold up.

    Graph: an edge for each pattern and distinct value in it. Scores of values: 1 for seeds of the
    kind, 0 for seeds of others; of candidates 0 at first, then 1 minus the product of what the
    patterns that hold the value leave open.
    """
    mentions = scans.select(F.explode("mentions").alias("m")).select("m.*")
    edges = saved(
        mentions.select("value", "kind", F.explode(F.array("before", "around")).alias("pattern"))
        .groupBy("pattern", "value")
        .agg(F.max("kind").alias("seed")),
        "pattern-edges",
    )
    # only patterns with enough seeds of a kind can come to anything
    rooted = (
        edges.where("seed >= 0")
        .groupBy("pattern", F.col("seed").alias("kind"))
        .agg(F.count("*").alias("support"))
        .where(F.col("support") >= MIN_SUPPORT)
        .select("pattern", "kind", "support")
    )
    graph = saved(edges.join(saved(rooted, "rooted-patterns"), "pattern"), "pattern-graph")
    scored = graph.withColumn("score", F.when(F.col("seed") == F.col("kind"), 1.0).otherwise(0.0))
    patterns = None
    for _ in range(rounds):
        patterns = saved(
            scored.groupBy("kind", "pattern").agg((F.sum("score") / (F.count("*") + 1)).alias("confidence")), "patterns"
        )
        values = (
            graph.where("seed < 0")
            .join(patterns, ["kind", "pattern"])
            .groupBy("kind", "value")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("reached"))
        )
        scored = graph.join(saved(values, "values"), ["kind", "value"], "left").withColumn(
            "score",
            F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed") >= 0, 0.0).otherwise(F.coalesce("reached", F.lit(0.0))),
        )
    return patterns.where(F.col("confidence") >= MIN_CONFIDENCE)


def discovered(scans: DataFrame, patterns: DataFrame) -> DataFrame:
    """doc_id, hash of the text and the further spans (``added``): candidates in confident patterns, of
    the kind that is surest."""
    held = saved(patterns, "confident-patterns")
    open_ = scans.select("doc_id", "_text_hash", F.explode("mentions").alias("m")).where("m.kind < 0")
    hits = open_.select("doc_id", "_text_hash", "m.start", "m.end", "m.value", F.explode(F.array("m.before", "m.around")).alias("pattern")).join(
        held, "pattern"
    )
    best = hits.groupBy("doc_id", "_text_hash", "start", "end").agg(
        F.max(F.struct("confidence", (-F.col("kind")).alias("kind"), "value")).alias("best")
    )
    span = F.struct("start", (-F.col("best.kind")).alias("kind"), "end", F.col("best.value").alias("value"))
    return saved(best.groupBy("doc_id", "_text_hash").agg(F.collect_set(span).alias("added")), "added-spans")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` (spans of the fixed patterns) and ``spans`` (these and the discovered ones, by
    start and kind), one row for each row of ``docs``."""
    scans = scanned(docs)
    added = discovered(scans, confident_patterns(scans)).toDF("__id", "__hash", "__added")
    both = scans.join(added, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("_text_hash") == F.col("__hash")), "left")
    return both.select("doc_id", "base", _with_added(F.col("base"), F.col("__added")).alias("spans"))


def _with_added(base: Column, added: Column) -> Column:
    return F.array_sort(F.concat(base, F.coalesce(added.cast(_FOUND), F.array().cast(_FOUND))))


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap the first
    one's mark stands for all."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        kept = F.substring(text, (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        more = F.when(x["start"] >= state["at"], F.array(kept, F.get(names, x["kind"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.concat(state["out"], more).alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their columns, and the spans in ``text`` masked. Null texts stay null."""
    scans = scanned(docs)
    added = discovered(scans, confident_patterns(scans)).toDF("__id", "__hash", "__added")
    text = F.coalesce("text", F.lit(""))
    found = docs.join(added, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    names = docs.columns
    with_spans = found.select(*names, _with_added(spans(text), F.col("__added")).alias("__spans"))
    return with_spans.select(
        *[F.when(F.col("text").isNotNull(), masked(F.col("text"), F.col("__spans"))).alias("text") if c == "text" else c for c in names]
    )
