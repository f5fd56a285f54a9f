"""Personal data: base patterns, and contextual patterns bootstrapped from what they find. DataFrame functions only."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, delete, stash

KINDS = ("email", "ip", "card", "phone")
WHITE = " \t\n\x0b\x0c\r"
#: Patterns as contracted, written so that no start or length of a run is tried twice: a match begins where a run
#: begins or the last match ended, and repetitions whose follower lies outside their class are possessive.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"(?:\\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "(?<![0-9])[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: What a text must hold for its pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: A word with a digit or an @ and, after single spaces, words of digits and signs that go on with it.
TOKEN = f"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+(?:(?<=[0-9)])\\x20[^{SPACE}\\p{{L}}0-9]*+[0-9][^{SPACE}\\p{{L}}]*+(?![^{SPACE}]))*+"
#: What stands before an identifier in its own word: signs, or a name that ends in : or =; a bracket stays if it is closed before more digits.
LEAD = "^(?:[^0-9@+(]*[:=])?[^A-Za-z0-9+(]*+(?:\\((?![^()]*\\)[^()]*[0-9]))?"
NOTHING = "array<struct<start:int,end:int,value:string>>"
SPANS = "array<struct<start:int,k:int,end:int>>"
#: Signs that context words are compared without.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Values that one step of a running sum or maximum goes through, and code points of a block of text.
STEP, CHARS = 64, 256


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, join, zero: int) -> Column:
    """For each of an array of numbers what ``join`` makes of those before it. In blocks, so that arrays that grow are short."""

    def within(xs: Column) -> Column:
        start = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda a, x: F.struct(join(a["at"], x).cast("int").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(xs, start, step, lambda a: a["out"])

    def whole(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(zero), lambda a, x: join(a, x).cast("int"))

    def blocks(xs: Column) -> Column:
        # taken one by one: slice() would copy the whole array each time
        take = lambda i: F.filter(F.transform(F.sequence(i * STEP, i * STEP + STEP - 1), lambda j: F.get(xs, j)), lambda x: x.isNotNull())
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / STEP).cast("int")), take)

    def spread(parts: Column, starts: Column) -> Column:
        return let(starts, lambda before: spread_from(parts, before))

    def spread_from(parts: Column, before: Column) -> Column:
        return F.flatten(F.transform(parts, lambda xs, i: let(F.get(before, i), lambda b: F.transform(within(xs), lambda x: join(x, b).cast("int")))))

    def deep(xs: Column) -> Column:
        return let(blocks(xs), lambda parts: let(F.transform(parts, whole), lambda sums: spread(parts, let(blocks(sums), lambda two: spread(two, within(F.transform(two, whole)))))))

    return let(values, lambda xs: F.when(F.size(xs) <= STEP, within(xs)).otherwise(deep(xs)))


def plus(a: Column, b: Column) -> Column:
    return a + b


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern as structs (start, end, value), in code points; what lies between them is cut by the same pattern."""
    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")), placed)


def placed(cut: Column) -> Column:
    """Structs (start, end, value) of ``cut``'s values, from their lengths and those of the gaps before them."""
    values, gap = cut["values"], lambda i: F.length(F.get(cut["gaps"], i))
    starts = running(F.transform(values, lambda v, i: F.length(v) + gap(i)), plus, 0)

    def place(before: Column) -> Column:
        return F.transform(values, lambda v, i: let((F.get(before, i) + gap(i)).cast("int"), lambda at: F.struct(at.alias("start"), (at + F.length(v)).cast("int").alias("end"), v.alias("value"))))

    return F.when(F.size(values) == 0, F.array().cast(NOTHING)).otherwise(let(starts, place))


def luhn(digits: Column) -> Column:
    """Whether a string of 12 to 19 digits has a right check digit."""
    back = F.reverse(digits)

    def add(total, i):
        x = F.substring(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, 2 * x - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(f"^{PART}\\.{PART}\\.{PART}\\.{PART}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))


def _valid(kind: str, x: Column) -> Column:
    return valid(kind, x["value"])


def _span(k: int, x: Column) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"))


def _is(k: int, s: Column) -> Column:
    return s["k"] == k


def base_spans(text: Column) -> Column:
    """Valid base spans of a text, as structs (start, k, end), sorted; k is the kind's place in KINDS."""
    parts = []
    for k, kind in enumerate(KINDS):
        found = F.filter(located(text, PATTERNS[kind]), partial(_valid, kind))
        spans = F.transform(found, partial(_span, k))
        there = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike("[0-9](?:[\\x20-]?[0-9]){11}")
        parts.append(F.when(there, spans).otherwise(F.array().cast(SPANS)))
    return F.sort_array(F.concat(*parts))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def plain(text: Column) -> Column:
    """Text as context words are compared: lower case, without signs."""
    return F.lower(F.translate(text, SIGNS, ""))


def kind_of(value: Column) -> Column:
    """The kind whose base pattern a whole value matches, as its place in KINDS, or null."""
    out = F.lit(None).cast("int")
    for k, kind in reversed(list(enumerate(KINDS))):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$") & valid(kind, value), k).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Identifier-like words and their context: structs (start, end, value, left, right, k).

    The value is a word, or several of digits, without a name such as ``tel:`` before it
    and punctuation at its ends; left and right are up to two words next to it, as
    plain() has them (left, the name before it if there is one); k is the kind of which
    the value is an identifier by the base patterns, or null.
    """

    def describe(cut: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            lead = F.regexp_extract(x["value"], LEAD, 0)
            return let(F.struct(lead.alias("lead"), core(x["value"], lead).alias("core")), lambda c: facts(x, i, c))

        def facts(x: Column, i: Column, c: Column) -> Column:
            start = (x["start"] + F.length(c["lead"])).cast("int")
            before = F.trim(plain(F.concat(F.translate(F.get(cut["gaps"], i), WHITE, "      "), c["lead"])))
            after = F.trim(plain(F.translate(F.get(cut["gaps"], i + 1), WHITE, "      ")))
            return F.struct(
                start.alias("start"), (start + F.length(c["core"])).cast("int").alias("end"), F.lower(c["core"]).alias("value"),
                F.substring_index(before, " ", -2).alias("left"), F.substring_index(after, " ", 2).alias("right"), kind_of(c["core"]).alias("k"),
            )

        return let(placed(cut), lambda found: F.transform(found, one))

    def core(value: Column, lead: Column) -> Column:
        return F.regexp_replace(F.substring(value, F.length(lead) + 1, F.length(value)), "(?<=[A-Za-z0-9])[^A-Za-z0-9]*+$", "")

    none = F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string,k:int>>")
    cut = F.struct(F.split(text, TOKEN, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)).alias("values"))
    return F.when(text.rlike("[0-9@]"), let(cut, describe)).otherwise(none)


def forms(value: Column) -> Column:
    """What a value looks like, from close to coarse: each digit as 9 and runs of letters as a; runs of digits too; the characters it is of and about how many digits."""
    letters = F.regexp_replace(value, "[\\p{L}]+", "a")
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    count = F.when(digits < 7, "few").when(digits < 12, "7").when(digits < 20, "12").otherwise("20")
    coarse = F.when(value.contains("@"), F.lit("@")).when(value.rlike("\\p{L}"), F.lit("a9")).otherwise(F.concat(F.lit("9x"), count))
    return F.array(F.regexp_replace(letters, "[0-9]", "9"), F.regexp_replace(letters, "[0-9]+", "9+"), coarse)


def cues(contexts: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """(cue): the words of ``contexts(word)``, a row each time one stands next to an identifier-like word, that stand elsewhere in ``texts(text)`` so seldom that these are ``share`` of all."""
    near = contexts.groupBy("word").agg(F.count("*").alias("near"))
    # summed by word before the shuffle
    every = texts.select(F.explode(F.split(plain(F.col("text")), f"[{SPACE}]+")).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return near.join(every, "word").filter(F.col("near") >= share * F.col("n")).select(F.col("word").alias("cue"))


def bootstrap(facts: DataFrame, texts: DataFrame, rounds: int, support: int, confidence: float, share: float) -> DataFrame:
    """New spans ``(key, start, k, end)`` from ``facts(key, tokens)`` and ``texts(text)``.

    A pattern is one word or two left or right of a token, with the token's form at one of
    three levels; an instance is a token's text. They form a graph whose edges count once,
    however often they occur. Only patterns with a cue among their words count: a word of
    which at least ``share`` of all places in the corpus are next to identifier-like words.

    Instances that base patterns find have score 1. In each round a pattern's confidence
    for a kind is the sum of its instances' scores over their number, if at least
    ``support`` of them are known; an instance's score is the best confidence among its
    patterns that reach ``confidence``. What has a score in the end and isn't a base span
    is new.
    """
    seen = stash(facts.select("key", F.explode("tokens").alias("t")).select("key", "t.*"), "pii-seen")
    last, first = F.substring_index("left", " ", -1), F.substring_index("right", " ", 1)
    sides = [("l", last), ("l2", F.col("left")), ("r", first), ("r2", F.col("right"))]
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), w.alias("words")) for s, w in sides]))
    wide = seen.groupBy("value", "left", "right").agg(F.max("k").alias("k"), F.count("*").alias("n")).withColumn("side", sides)
    wide = wide.filter("side.words <> '' AND (length(side.side) = 1 OR instr(side.words, ' ') > 0)")
    # only contexts of enough known identifiers can come to be trusted in the first place
    single = wide.filter("length(side.side) = 1").select(F.col("side.words").alias("word"), "value", "n", "k")
    known = single.filter("k IS NOT NULL").groupBy("word").agg(F.count_distinct("value").alias("m")).filter(F.col("m") >= support).select("word")
    near = single.join(known, "word", "left_semi").select("word", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))))
    found = stash(cues(near.select("word"), texts, share), "pii-cues")
    words = wide.select("value", "k", "side.side", "side.words", F.explode(F.array_distinct(F.split("side.words", " "))).alias("cue"))
    words = words.join(found, "cue", "left_semi").withColumn("form", F.explode(F.array_distinct(forms(F.col("value")))))
    pattern = F.concat_ws("\t", "side", "words", "form").alias("pattern")
    edges = stash(words.groupBy(pattern, "value").agg(F.max("k").alias("seed")), "pii-edges")
    scores = edges.filter("seed IS NOT NULL").groupBy("value").agg(F.max("seed").alias("k")).withColumn("score", F.lit(1.0))
    scores = seeds = stash(scores, "pii-scores")
    for _ in range(0 if edges.isEmpty() else rounds):
        joined = edges.join(scores, "value", "left")
        total = joined.groupBy("pattern").agg(F.count("*").alias("n"))
        good = joined.filter("score > 0").groupBy("pattern", "k").agg(F.sum("score").alias("s"), F.count("*").alias("m"))
        good = good.filter(F.col("m") >= support).join(total, "pattern").filter(F.col("s") >= confidence * F.col("n"))
        good = good.select("pattern", "k", (F.col("s") / F.col("n")).alias("c"))
        best = edges.join(good, "pattern").groupBy("value").agg(F.max(F.struct("c", "k")).alias("b"))
        new = best.join(seeds, "value", "left_anti").select("value", F.col("b.k").alias("k"), F.col("b.c").alias("score"))
        old, scores = scores, stash(seeds.unionByName(new), "pii-scores")
        if old is not seeds:
            delete(old)
    # a known text counts wherever it stands, in a context that is trusted or not
    new = stash(seen.filter("k IS NULL").drop("k").join(scores.filter("score < 1"), "value").select("key", "start", "k", "end").distinct(), "pii-found")
    for old in {id(t): t for t in (seen, found, edges, scores, seeds)}.values():
        delete(old)
    return new


def apart(new: DataFrame, facts: DataFrame) -> DataFrame:
    """Those of ``new(key, start, k, end)`` that overlap no base span of ``facts(key, base)``, found in the order of their starts."""
    base = facts.join(new.select("key").distinct(), "key", "left_semi").select("key", F.explode("base").alias("b")).select("key", "b.start", "b.k", "b.end", F.lit(True).alias("fixed"))
    both = base.unionByName(new.withColumn("fixed", F.lit(False))).distinct()
    row = Window.partitionBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.when(F.col("fixed"), F.col("end"))).over(row.orderBy("start", F.desc("fixed")))
    after = F.min(F.when(F.col("fixed"), F.col("start"))).over(row.orderBy(F.desc("start"), F.desc("fixed")))
    marked = both.withColumn("before", before).withColumn("after", after).filter("NOT fixed")
    free = F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))
    return marked.filter(free).select("key", "start", "k", "end")


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by doc_id and, within one, by a hash and the length of the text."""
    return F.concat_ws("-", F.coalesce(doc_id.cast("string"), F.lit("none")), F.hex(F.xxhash64(text)), F.length(text))


def discover(docs: DataFrame, rounds: int, support: int, confidence: float, share: float) -> tuple[DataFrame, DataFrame]:
    """(facts, new): ``facts(doc_id, key, base, tokens)`` a row and ``new(_key, new)``, the spans that bootstrapped patterns add, by key.

    Rows alike in doc_id and text have one key and the same spans.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"))
    facts = texts.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), base_spans(F.col("text")).alias("base"), tokens(F.col("text")).alias("tokens"))
    facts = stash(facts, "pii-facts")
    found = bootstrap(facts.filter(F.size("tokens") > 0).select("key", "tokens"), texts.select("text"), rounds, support, confidence, share)
    # spans of one text, as many as it has words at most
    new = apart(found, facts.select("key", "base")).groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("start", "k", "end")).alias("new"))
    return facts, stash(new, "pii-new")


def together(base: Column, new: Column) -> Column:
    return F.sort_array(F.concat(base, F.coalesce(new, F.array().cast(SPANS))))


#: Rounds of the bootstrap, known instances a pattern needs, its least confidence, and the least share of a cue's places.
SETTINGS = {"rounds": 3, "support": 5, "confidence": 0.6, "share": 0.1}


def find(docs: DataFrame, **settings) -> DataFrame:
    """Spans of each row of ``docs(doc_id, text)``: doc_id, base and spans, sorted arrays of structs (start, k, end).

    ``base`` is what the fixed patterns find in the whole text, ``spans`` also what the
    bootstrapped ones add; a span of these overlaps no base one. ``settings`` replace
    those of SETTINGS. A null or empty text has none; rows with the same doc_id and text
    have the same; a null doc_id is kept; an empty table gives no rows; other columns are
    ignored. The work on a text grows with its length, however many spans it has.
    """
    facts, new = discover(docs, **(SETTINGS | settings))
    out = facts.select("doc_id", "key", "base").join(new, F.col("key") == F.col("_key"), "left")
    return out.select("doc_id", "base", together(F.col("base"), F.col("new")).alias("spans"))


def digest(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans of each row; see find()."""
    found = find(docs, **settings)
    counts = [F.size(F.filter("base", partial(_is, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def replaced(text: Column, spans: Column) -> Column:
    """A text with the runs of its sorted, maybe overlapping spans replaced by the name of each run's first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHARS}}}"), F.lit(0))

    def between(parts: Column, start: Column, end: Column) -> Column:
        """The text from start to end, by the blocks that it lies in."""
        at = F.floor(start / CHARS).cast("int")
        some = F.array_join(F.transform(F.sequence(at, F.floor((end - 1) / CHARS).cast("int")), lambda i: F.get(parts, i)), "")
        return F.when(end > start, F.substring(some, start - at * CHARS + 1, end - start)).otherwise("")

    def heads(reach: Column) -> Column:
        """The first span of each run with where the run before ends."""
        return F.filter(F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["k"].alias("k"), F.get(reach, i).alias("since"))), lambda s: s["start"] >= s["since"])

    def assemble(parts: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        pieces = let(running(ends, F.greatest, 0), lambda reach: F.transform(heads(reach), lambda s: F.concat(between(parts, s["since"], s["start"]), F.get(names, s["k"]))))
        rest = let(F.array_max(ends), lambda end: between(parts, end, F.length(text)))
        return F.concat(F.array_join(pieces, ""), rest)

    return F.when(F.size(spans) > 0, let(blocks, assemble)).otherwise(text)


def redact(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind, as in [EMAIL], and n_chars, if there, renewed.

    A span that begins within another is joined to it under the first one's name. Null
    texts stay null, texts without spans as they are.
    """
    facts, new = discover(docs, **(SETTINGS | settings))
    delete(facts)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("_row"), text.alias("_text"), row_key(F.col("doc_id"), text).alias("_at"), base_spans(text).alias("_base"))
    rows = rows.join(new, F.col("_at") == F.col("_key"), "left").withColumn("_spans", together(F.col("_base"), F.col("new")))
    rows = rows.withColumn("_clean", F.when(F.size("_spans") > 0, replaced(F.col("_text"), F.col("_spans"))).otherwise(F.col("_row")["text"]))
    made = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return rows.select(*[(made[c] if c in made else F.col("_row")[c]).alias(c) for c in columns])
