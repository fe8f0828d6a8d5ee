"""Personal data: exact base patterns, and contextual extraction bootstrapped
from them.

Base entities (email, ip, card, phone) come from regular expressions.  They
are the seeds of a bootstrap over candidates: any run without blanks that has
a digit or an "@", and groups of digits joined by single blanks.  The two words
before a candidate and the two after it, whatever stands there, are its lexical
patterns; digits in them count as 0.  A seed has the patterns of the candidate
that it starts in, so the same place always gives the same patterns.  Spark
builds the graph of patterns and values over the whole corpus; in each round

* a pattern's confidence is the share of known values among all distinct
  values that it extracts, if it extracts enough known ones, and it takes the
  kind of most of them;
* an unknown value whose shape suits that kind becomes known when at least
  ``MIN_PATTERNS`` distinct confident patterns extract it (their confidences
  are combined by noisy-or).

Rounds go on until one adds no value; known values only grow, so this ends.
Values that are known at the end mark further spans wherever a confident
pattern extracts them, unless a base span overlaps the candidate.  All of it
is DataFrame expressions: no Python runs on the executors.

Defined results: null text counts as empty; repeated rows get equal spans, and
are one node of the graph; null doc_ids stay rows; texts without entities give
zero counts and empty strings; an empty table gives no rows; long words and
long rows of numbers take time in proportion to their length, many matches in
one text at most their number to the power of 1.5; at the start or end of a
text one word may be a context; only doc_id and text are read, and ``redact``
names its own columns so that further ones cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import staged
from eventide.llm.quality import let

KINDS = ("email", "ip", "card", "phone")

#: Fixed patterns.  Each is the contract's expression in a form that reads a
#: run of characters once: possessive quantifiers where the next character
#: cannot belong to the run, and no start inside a run that failed from its
#: beginning (\G allows the place where the last match ended).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Groups of digits joined by single blanks, or a word with a digit or "@".
CANDIDATE = (
    r"(?<![^\x20\x09-\x0D])(?:[+(]*+[0-9][0-9().+-]*+(?:\x20[(]?+[0-9][0-9().-]*+)++|[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]*+"
)

MIN_SEEDS = 3  # known values that a pattern must extract
CONFIDENT = 0.8
MIN_PATTERNS = 2  # confident patterns that must extract a new value


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all matches, in code points.  The parts
    between matches and the matches themselves alternate, so running lengths
    give the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def place(values: Column, rests: Column) -> Column:
        steps = F.zip_with(F.slice(rests, 1, F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("g"), v.alias("v")))
        start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

        def step(a: Column, s: Column) -> Column:
            return let(
                a["at"] + s["g"],
                lambda b: F.struct(
                    (b + F.length(s["v"])).alias("at"),
                    F.array_append(a["out"], F.struct(b.alias("start"), (b + F.length(s["v"])).alias("end"), s["v"].alias("value"))).alias("out"),
                ),
            )

        def moved(block: Column, by: Column) -> Column:
            return F.transform(
                block["out"], lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value"))
            )

        # appending copies the array, so places are found in blocks, and the blocks moved by running sums
        blocks = let(steps, lambda x: F.transform(_blocks(x), lambda own: F.aggregate(own, start, step)))
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        before = lambda x: F.aggregate(
            x, none, lambda a, k: F.struct((a["at"] + k["at"]).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"]
        )
        return let(blocks, lambda x: F.flatten(F.zip_with(x, before(x), moved)))

    return let(found, lambda v: F.when(F.size(v) > 0, let(gaps, lambda g: place(v, g))).otherwise(_none()))


def _block_size(n: Column) -> Column:
    return F.greatest(F.lit(32), F.ceil(F.sqrt(n)).cast("int"))


def _blocks(rows: Column) -> Column:
    """An array that is not empty, cut into about as many blocks as each has entries."""
    n = F.size(rows)
    return let(_block_size(n), lambda b: F.transform(F.sequence(F.lit(0), n - 1, b), lambda i: F.slice(rows, i + 1, b)))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def _luhn(digits: Column) -> Column:
    chars = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            chars,
            lambda c, i: let(
                c.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end, value), sorted by start and kind."""
    text = F.coalesce(text, F.lit(""))
    may = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]")}

    def kind_spans(t: Column, k: int, kind: str) -> Column:
        hit = F.filter(_matches(t, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        rows = F.transform(hit, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))
        return F.when(may[kind], rows).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))

    return F.sort_array(F.concat(*[kind_spans(text, k, kind) for k, kind in enumerate(KINDS)]))


def span_string(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


#: One or two words; anchored, so that a long word is read once.
FIRST_WORDS = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++(?:[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)?+)"


def _context(rest: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(rest, FIRST_WORDS, 1)), "[0-9]", "0")


def _candidates(text: Column) -> Column:
    """Array of candidates with the two words before and after."""
    text = F.coalesce(text, F.lit(""))
    gaps = F.split(text, CANDIDATE, -1)
    shape = "array<struct<start:int,end:int,value:string,before:string,after:string>>"

    def around(found: Column, g: Column) -> Column:
        # gaps hold whole words, so the two words next to a candidate lie in two gaps and the two candidates there
        def value(i: Column) -> Column:
            return F.coalesce(F.get(found, i)["value"], F.lit(""))

        def gap(i: Column) -> Column:
            return F.coalesce(F.get(g, i), F.lit(""))

        return F.transform(
            found,
            lambda m, i: F.struct(
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["value"].alias("value"),
                F.reverse(_context(F.reverse(F.concat(value(i - 2), gap(i - 1), value(i - 1), gap(i))))).alias("before"),
                _context(F.concat(gap(i + 1), value(i + 1), gap(i + 2), value(i + 2))).alias("after"),
            ),
        ).cast(shape)

    found = let(_matches(text, CANDIDATE), lambda m: F.when(F.size(m) > 0, let(gaps, lambda g: around(m, g))).otherwise(F.array().cast(shape)))
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(shape))


def _trimmed(value: Column) -> Column:
    return F.regexp_replace(value, r"^[^A-Za-z0-9@+(]+|[^A-Za-z0-9)]+$", "")


def suits(kind: Column, value: Column) -> Column:
    """Whether a token could be an identifier of the kind at all."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    letters = value.rlike("[A-Za-z]")
    return (
        F.when(kind == 0, value.rlike(r"^[^@]+@[^@]+$"))
        .when(kind == 1, value.rlike(r"^[0-9A-Fa-f]*([.:][0-9A-Fa-f]*){3,7}$") & (digits >= 4))
        .when(kind == 2, digits.between(12, 19) & ~letters)
        .when(kind == 3, digits.between(7, 15) & ~letters)
        .otherwise(False)
    )


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, tokens) for each row of ``docs``: key identifies
    doc_id and text, base is the array of base spans, tokens the candidates
    with their contexts."""
    return docs.select("doc_id", _key().alias("key"), base_spans(F.col("text")).alias("base"), _candidates(F.col("text")).alias("tokens"))


def _key() -> Column:
    """Identity of doc_id and text, in two hashes."""
    return F.concat(F.hex(F.xxhash64("doc_id", "text")), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _placed(found: DataFrame) -> DataFrame:
    """(key, value, start, end, before, after, seed): the base spans as seeds,
    with the contexts of the candidates that they start in, and the candidates
    that no base span overlaps (seed null)."""
    once = found.where(F.size("tokens") > 0).dropDuplicates(["key"])
    kinds = F.transform("base", lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("turn"), s["end"].alias("end"), s["value"].alias("value"),
                                                   F.lit("").alias("before"), F.lit("").alias("after"), s["kind"].alias("seed")))
    tokens = F.transform("tokens", lambda m: F.struct(m["start"].alias("at"), F.lit(0).alias("turn"), m["end"].alias("end"), m["value"].alias("value"),
                                                      m["before"].alias("before"), m["after"].alias("after"), F.lit(None).cast("int").alias("seed")))
    rows = once.select("key", F.explode(F.concat(tokens, kinds)).alias("x")).select("key", "x.*")
    order = Window.partitionBy("key").orderBy("at", "turn", "end").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("turn") == 0, F.struct(F.col("at").alias("first"), "before", "after")), ignorenulls=True).over(order)
    reach = F.max(F.when(F.col("turn") == 1, F.col("end"))).over(order)
    rows = rows.select("key", "at", "turn", "end", "value", "seed", own.alias("own"), reach.alias("reach"))
    inside = F.max("turn").over(Window.partitionBy("key", "own.first"))
    rows = rows.select("*", inside.alias("inside"))
    free = (F.col("inside") == 0) & (F.coalesce("reach", F.lit(0)) <= F.col("at"))
    rows = rows.where((F.col("turn") == 1) | free)
    value = F.when(F.col("turn") == 1, F.col("value")).otherwise(_trimmed(F.col("value")))
    lead = F.when(F.col("turn") == 1, 0).otherwise(F.length(F.regexp_extract("value", r"^[^A-Za-z0-9@+(]+", 0)))
    rows = rows.select("key", value.alias("value"), (F.col("at") + lead).alias("start"), "own.before", "own.after", "seed")
    return rows.where(F.length("value") >= 4).withColumn("end", F.col("start") + F.length("value"))


def bootstrap(found: DataFrame) -> DataFrame:
    """(key, start, kind, end, value): spans of unseen identifiers.  ``found``
    is the staged result of ``find``."""
    cut = _placed(found)
    sides = F.array(
        F.struct(F.lit("<").alias("side"), F.col("before").alias("words")),
        F.struct(F.lit(">").alias("side"), F.col("after").alias("words")),
    )
    edge = cut.select("key", "value", "start", "end", "seed", F.explode(sides).alias("p")).where("p.words <> ''")
    edge = staged(edge.select("key", "value", "start", "end", "seed", F.concat("p.side", "p.words").alias("pattern")), "pii-edges")
    # graph of distinct patterns and values; a hot word pair is aggregated before it is shuffled
    graph = staged(edge.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pii-graph")
    known = graph.where("seed is not null").groupBy("value").agg(F.max("seed").alias("kind"))
    while True:
        known = staged(known, "pii-known")
        flagged = graph.join(known, "value", "left")
        sums = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n{k}") for k in range(len(KINDS))]
        most = F.greatest(*[F.col(f"n{k}") for k in range(len(KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"n{k}") == most, F.lit(k)) for k in range(len(KINDS))])
        scored = flagged.groupBy("pattern").agg(F.count("*").alias("n"), *sums)
        sure = scored.where(most >= MIN_SEEDS).select("pattern", kind.alias("kind"), (most / F.col("n")).alias("confidence"))
        sure = staged(sure.where(F.col("confidence") >= CONFIDENT), "pii-patterns")
        fresh = (
            graph.join(sure, "pattern").where(suits(F.col("kind"), F.col("value")))
            .groupBy("value", "kind")
            .agg(F.count("*").alias("n"), F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))).alias("miss"))
            .where((F.col("n") >= MIN_PATTERNS) & (1 - F.exp("miss") >= CONFIDENT))
            .groupBy("value").agg(F.min("kind").alias("kind"))
            .join(known.select("value"), "value", "left_anti")
        )
        fresh = staged(fresh, "pii-fresh")
        if fresh.isEmpty():
            break
        known = known.unionByName(fresh)
    new = edge.where("seed is null").join(sure, "pattern").where(suits(F.col("kind"), F.col("value")))
    new = new.select("key", "start", "end", "value", "kind").join(known, ["value", "kind"])
    return new.select("key", "start", "kind", "end", "value").distinct()


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, spans) for each row of ``docs``: the base spans and
    all spans, as sorted arrays of (start, kind, end, value)."""
    found = staged(find(docs.select("doc_id", "text")), "pii-found")
    extra = bootstrap(found).groupBy("key").agg(F.collect_set(F.struct("start", "kind", "end", "value")).alias("more"))
    rows = found.select("doc_id", "key", "base").join(extra, "key", "left")
    return rows.select(
        "doc_id", "key", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "more"))).alias("spans")
    )


def _redacted(text: Column, spans: Column) -> Column:
    """``text`` with its sorted spans (at least one) replaced.  Cutting a long
    text costs its length, so it is cut into stretches of many spans first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def stretch(own: Column, low: Column, high: Column, done: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.greatest(low, done).alias("at"))

        def step(t: Column, a: Column, s: Column) -> Column:
            more = F.concat(a["out"], F.substring(t, a["at"] - low + 1, s["start"] - a["at"]), F.element_at(names, s["kind"] + 1))
            return F.struct(F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

        return let(
            F.substring(text, low + 1, high - low),
            lambda t: F.aggregate(own, start, lambda a, s: step(t, a, s), lambda a: F.concat(a["out"], F.substring(t, a["at"] - low + 1, F.length(t)))),
        )

    def whole(x: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        done = F.aggregate(
            x,
            none,
            lambda a, own: F.struct(
                F.greatest(a["at"], F.array_max(F.transform(own, lambda s: s["end"]))).alias("at"), F.array_append(a["out"], a["at"]).alias("out")
            ),
            lambda a: a["out"],
        )
        parts = let(
            done,
            lambda d: F.transform(
                x, lambda own, i: stretch(own, own[0]["start"], F.coalesce(F.get(x, i + 1)[0]["start"], F.length(text)), F.get(d, i))
            ),
        )
        return F.concat(F.substring(text, F.lit(1), x[0][0]["start"]), F.array_join(parts, ""))

    return let(_blocks(spans), whole)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; other
    columns, and texts without spans, stay as they are."""
    found = staged(find(docs.select("doc_id", "text")), "pii-found")
    mark = "k" + "_" * max(map(len, docs.columns))  # longer than any column's name
    more = bootstrap(found).groupBy("key").agg(F.collect_set(F.struct("start", "kind", "end", "value")).alias(f"{mark}more"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.withColumn(mark, _key()).join(more.withColumnRenamed("key", mark), mark, "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    spans = F.sort_array(F.concat(base_spans(F.col("text")), F.coalesce(F.col(f"{mark}more"), none)))
    text = let(spans, lambda s: F.when(F.size(s) > 0, _redacted(F.col("text"), s)).otherwise(F.col("text")))
    return joined.select(*[text.alias(c) if c == "text" else col for c, col in zip(docs.columns, columns, strict=True)])
