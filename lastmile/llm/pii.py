"""Personal data: generators propose spans, boosted trees select them.

Base spans follow exact rules (pattern, checksum, range). Further generators with loose
patterns propose overlapping candidates of written-around forms. Trees boosted on format and
context features score them; a threshold per generator, calibrated on rows that the trees
have not seen, selects redactions. Trees and thresholds come from the candidates of all
distinct texts, counted by their features. Everything is DataFrame expressions on the row of
the document: regular expressions, arrays and, for the fitted trees, nested conditions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.shield import restored, shielded
from lastmile.operators.sizing import written

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repeats keep matching linear; the look-behind
# stops searches from starting inside a run that has failed already (\G: unless a match ended there).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that a text can have a match at all.
BASE_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

# Loose generators, by name: kind, pattern, test that a text can have a match.
_AT, _DOT = r"(?: ?[\[({](?:at|@)[\])}] ?| at | ?@ ?)", r"(?: ?[\[({](?:dot|\.)[\])}] ?| dot |\.)"
GENERATORS = {
    "email_words": (
        "email", rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}",
        r"(?i)[\[({](?:at|@|dot)[\])}]| dot | @|@ ",
    ),
    "ip_broken": (
        "ip", r"(?<![0-9.])[0-9]{1,3}(?: ?[\[({]?(?:\.|dot)[\])}]? ?[0-9]{1,3}){3}(?![0-9])",
        r"(?i)[0-9] ?[\[({]?(?:\.|dot)[\])}]? ?[0-9]",
    ),
    "card_groups": (
        "card", r"(?<![0-9A-Za-z])[0-9]{3,6}(?:[\x20._/-]{1,3}[0-9]{2,6}){2,5}(?![0-9A-Za-z])",
        r"[0-9]{3}[\x20._/-]{1,3}[0-9]{2}",
    ),
    "phone_local": (
        "phone", r"(?<![0-9A-Za-z+])(?:00[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,4}){1,4}(?![0-9A-Za-z])",
        r"[0-9]{2}\)?[\x20./-]{1,2}[0-9]{2}",
    ),
}
BEFORE, AFTER = 32, 16  # characters of context
CONTEXT = {
    "email": r"(?i)mail|contact|write|reach|kontakt|courriel|correo",
    "ip": r"(?i)\bip\b|host|server|address|adresse|addr|from",
    "card": r"(?i)card|visa|credit|account|karte|carte|tarjeta|iban",
    "phone": r"(?i)tel|phone|call|mobile|fax|ruf|appel|llam",
}
NOT_PERSONAL = r"(?i)version|licen[cs]e|token|isbn|order|\$|€|page|section|\bno\."
FEATURES = (
    "generator", "length", "digits", "separators", "kinds_of_separator", "luhn", "parts_in_range", "groups",
    "brackets", "letters", "word_before", "sign_before", "quote_before", "word_after", "context",
    "not_personal", "first_digit",
)
MIN_PRECISION = 0.98
MIN_POSITIVE = 10  # right ones that a threshold must rest on
ROUNDS, DEPTH = 15, 3
MOST_BINS = 1024  # more than any feature has values, so that each value is a split of its own


BLOCK = 48  # array elements that are appended to, or pieces of a text that are put together, at a time


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(array: Column) -> Column:
    """The array cut into arrays of BLOCK elements."""
    last = F.floor((F.size(array) - 1) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(array, i * BLOCK + 1, F.lit(BLOCK)))
    return cut


def scanned(array: Column, carry: Column, element: str, step) -> Column:
    """(carry, out): ``step(carry, x)`` gives the next carry and an element of ``out`` for each x in turn.

    Elements are appended to an array of one block, and a full block to the outer array. Spark
    copies the state at each step, so that very many spans of one text still cost their square.
    """
    none, nothing = F.array().cast(f"array<{element}>"), F.array().cast(f"array<array<{element}>>")

    def over(state: Column, x: Column) -> Column:
        following, made = step(state["carry"], x)
        full = F.size(state["block"]) >= BLOCK
        return F.struct(
            following.alias("carry"), F.concat(F.when(full, none).otherwise(state["block"]), F.array(made)).alias("block"),
            F.when(full, F.concat(state["out"], F.array(state["block"]))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(carry.alias("carry"), none.alias("block"), nothing.alias("out"))
    return F.aggregate(
        array, start, over,
        lambda s: F.struct(s["carry"].alias("carry"), F.flatten(F.concat(s["out"], F.array(s["block"]))).alias("out")),
    )


def found(text: Column, pattern: str, hint: str) -> Column:
    """All leftmost non-overlapping matches: array of (start, end, match, before, after).

    Offsets are code points. They follow from the pieces between the matches.
    """
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g")
    )

    def around(z: Column) -> Column:
        return F.transform(
            z["m"], lambda m, i: F.struct(m.alias("m"), F.get(z["g"], i).alias("b"), F.get(z["g"], i + 1).alias("a"))
        )

    element = "struct<start:bigint,end:bigint,match:string,before:string,after:string>"

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.char_length(x["b"])
        end = start + F.char_length(x["m"])
        span = F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("match"),
            F.right(x["b"], F.lit(BEFORE)).alias("before"), F.left(x["a"], F.lit(AFTER)).alias("after"),
        )
        return end, span

    spans = bound(cut, lambda z: scanned(around(z), F.lit(0).cast("long"), element, add)["out"])
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(f"array<{element}>"))


def replaced(text: Column, spans: Column, mark) -> Column:
    """The text with each span replaced by ``mark(span)``; overlapping spans are one, marked by the first.

    Spans are sorted by start. Each block of them is cut out of the text once, and its pieces
    out of that.
    """
    piece = "struct<from:bigint,to:bigint,mark:string>"

    def cut(at: Column, s: Column) -> tuple[Column, Column]:
        own = F.when(s["start"] >= at, mark(s)).otherwise(F.lit(""))
        start, end = F.greatest(at, s["start"]), F.greatest(at, s["end"])
        return end, F.struct(at.alias("from"), start.alias("to"), own.alias("mark"))

    def joined_block(block: Column) -> Column:
        first = F.get(block, F.lit(0))["from"]
        last = F.element_at(block, -1)["to"]
        part = F.substr(text, first.cast("int") + 1, (last - first).cast("int"))
        return bound(F.struct(part.alias("part"), first.alias("first"), block.alias("block")), lambda z: F.array_join(
            F.transform(z["block"], lambda x: F.concat(
                F.substr(z["part"], (x["from"] - z["first"]).cast("int") + 1, F.greatest(x["to"] - x["from"], F.lit(0)).cast("int")), x["mark"],
            )), "",
        ))

    return bound(scanned(spans, F.lit(0).cast("long"), piece, cut), lambda z: F.concat(
        F.array_join(F.transform(blocks(z["out"]), joined_block), ""), F.substr(text, z["carry"].cast("int") + 1)
    ))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    backwards = F.reverse(digits_of(match))

    def value(i: Column) -> Column:
        d = F.substr(backwards, i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.greatest(F.char_length(backwards), F.lit(1)))
    total = F.aggregate(places, F.lit(0), lambda s, i: s + F.coalesce(value(i), F.lit(0)))
    return (F.char_length(backwards) > 0) & (total % 10 == 0)


def parts_in_range(match: Column) -> Column:
    """Whether every run of digits is a number up to 255."""
    parts = F.filter(F.split(match, "[^0-9]+"), lambda p: p != "")
    return F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def base_holds(kind: str, match: Column) -> Column:
    count = F.char_length(digits_of(match))
    return {
        "email": F.lit(True),
        "ip": parts_in_range(match),
        "card": count.between(12, 19) & luhn(match),
        "phone": count.between(9, 15),
    }[kind]


def base_spans(text: Column) -> Column:
    """Array of (start, end, kind number, match, before, after) of the exact rules, all kinds."""
    def of_kind(number: int, kind: str) -> Column:
        held = F.filter(found(text, BASE[kind], BASE_HINT[kind]), lambda s: base_holds(kind, s["match"]))
        return F.transform(held, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(number).alias("kind"),
            s["match"].alias("match"), s["before"].alias("before"), s["after"].alias("after"),
        ))

    by_kind = [of_kind(number, kind) for number, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*by_kind), lambda a, b: F.when(
        (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1).otherwise(1))


FILLER = "\ue000"  # of private use, in no pattern: stands for the characters of a span


def masked(text: Column, spans: Column) -> Column:
    """The text with every character of the spans as FILLER, so that offsets stay."""
    plain = replaced(text, spans, lambda s: F.repeat(F.lit(FILLER), (s["end"] - s["start"]).cast("int")))
    return F.when(F.size(spans) > 0, plain).otherwise(text)


def disjoint(spans: Column) -> Column:
    """Sorted spans with those that overlap made one, of the first one's kind."""
    element = "struct<start:bigint,end:bigint,kind:int>"
    as_span = lambda start, end, kind: F.struct(start.alias("start"), end.alias("end"), kind.alias("kind"))
    none = F.lit(None).cast(element)

    def step(open_: Column, s: Column) -> tuple[Column, Column]:
        apart = open_.isNull() | (s["start"] >= open_["end"])
        wider = as_span(open_["start"], F.greatest(open_["end"], s["end"]), open_["kind"])
        own = as_span(s["start"], s["end"], s["kind"])
        return F.when(apart, own).otherwise(wider), F.when(apart, open_)

    return bound(scanned(spans, none, element, step), lambda z: F.filter(F.concat(z["out"], F.array(z["carry"])), lambda s: s.isNotNull()))


def features(generator: int, kind: str, span: Column) -> Column:
    """Format and context features of a candidate, in the order of ``FEATURES``."""
    m, before, after = span["match"], span["before"], span["after"]
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    signs = F.regexp_replace(m, "[0-9A-Za-z]", "")
    count = F.char_length(digits_of(m))
    values = (
        F.lit(float(generator)), F.char_length(m), count, F.char_length(signs),
        F.size(F.array_distinct(F.split(signs, ""))), luhn(m), parts_in_range(m),
        F.size(F.split(m, "[^0-9A-Za-z]+")), m.rlike(r"[\[({]"), F.char_length(m) - count - F.char_length(signs),
        before.rlike("[0-9A-Za-z_]$"), before.rlike(r"[+#$%&*=/-]\s?$"), before.rlike("[\"'`]$"),
        after.rlike("^[0-9A-Za-z_]"), before.rlike(CONTEXT[kind]), before.rlike(NOT_PERSONAL),
        F.try_element_at(F.split(digits_of(m), ""), F.lit(1)).try_cast("int"),
    )
    return F.array(*[number(v) for v in values])


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def candidates(text: Column) -> Column:
    """Array of (start, end, kind, generator, x): proposals of all loose generators with features."""
    def proposed(number: int, kind: str, pattern: str, hint: str) -> Column:
        return F.transform(found(text, pattern, hint), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(number).alias("generator"), features(number, kind, s).alias("x"),
        ))

    return F.concat(*[proposed(number, *how) for number, how in enumerate(GENERATORS.values())])


def written_around(kind: Column, match: Column) -> Column:
    """Forms of a base span as people write them to evade the exact rules, for training."""
    bare = F.regexp_replace(match, r"^\+[0-9]{1,2}[\x20.-]?", "")
    digits = digits_of(match)
    email = [
        F.regexp_replace(F.replace(match, F.lit("@"), F.lit(at)), r"\.(?=[A-Za-z0-9-]+$)", dot)
        for at, dot in ((" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" @ ", "."))
    ]
    ip = [F.replace(match, F.lit("."), F.lit(dot)) for dot in ("[.]", "(.)", " . ", "[dot]")]
    grouped = F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1.")
    card = [grouped, F.replace(grouped, F.lit("."), F.lit(" - ")), F.replace(grouped, F.lit("."), F.lit("  "))]
    local = F.right(digits, F.lit(10))
    phone = [bare, F.concat(F.lit("00"), F.regexp_replace(match, r"[+()]", "")),
             F.regexp_replace(local, "^([0-9]{3})([0-9]{3})([0-9]+)$", "$1.$2.$3"),
             F.regexp_replace(local, "^([0-9]{3})([0-9]{3})([0-9]+)$", "$1-$2-$3")]
    choice = F.lit(None).cast("array<string>")
    for number, forms in enumerate((email, ip, card, phone)):
        choice = F.when(kind == number, F.array(*forms)).otherwise(choice)
    return choice


def training_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(part, generator, y, x, n): how many candidates of all distinct texts have these features.

    Positive ones cover a written-around base span, put back into its own context. Other
    candidates there are negative, and so are those of the texts that overlap no base
    span and fail their kind's own test; what passes it may be personal and is left out.
    The part, 0 to 2, is that of the text.
    """
    texts = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text")).distinct()
    based = written(texts.select(F.xxhash64("text").alias("_h"), "text", base_spans(F.col("text")).alias("base")))
    x = lambda name: F.col("c.x")[FEATURES.index(name)]
    tests = (x("brackets") == 1, x("parts_in_range") == 1, x("luhn") == 1, x("digits").between(10, 15))
    passes = F.element_at(F.array(*tests), F.col("c.generator") + 1)
    free = F.filter(candidates(F.col("text")), lambda c: ~F.exists("base", lambda b: overlaps(b, c)))
    plain = based.select("_h", F.explode(free).alias("c")).where(~passes).select("_h", "c", F.lit(0).alias("y"))
    spots = based.select("_h", F.explode("base").alias("s")).select(
        "_h", "s", F.explode(written_around(F.col("s.kind"), F.col("s.match"))).alias("form")
    )
    window = spots.select(
        "_h", F.concat("s.before", "form", "s.after").alias("text"), F.char_length("s.before").alias("a"),
        (F.char_length("s.before") + F.char_length("form")).alias("b"), F.col("s.kind").alias("kind"),
    )
    covered = F.least("b", "c.end") - F.greatest("a", "c.start")
    good = (F.col("c.kind") == F.col("kind")) & (covered >= 0.8 * (F.col("b") - F.col("a"))) & (
        F.col("c.end") - F.col("c.start") <= 1.2 * (F.col("b") - F.col("a"))
    )
    made = window.select("*", F.explode(candidates(F.col("text"))).alias("c")).select("_h", "c", good.cast("int").alias("y"))
    part = F.pmod(F.xxhash64("_h", F.lit("part")), F.lit(3)).cast("int")
    return (
        plain.unionAll(made).select(part.alias("part"), "c.generator", "y", "c.x")
        .groupBy("part", "generator", "y", "x").agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class SpanModel:
    """Boosted trees as an SQL condition on ``x`` and a threshold per generator (above 1: never)."""

    margin: str
    thresholds: tuple[float, ...]

    def score(self, x: str) -> str:
        return f"1.0D / (1.0D + exp(-2.0D * ({self.margin.replace('{x}', x)})))"


NO_MODEL = SpanModel("0.0D", (2.0,) * len(GENERATORS))


def _condition(node) -> str:
    """A fitted tree as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return f"{node.prediction()!r}D"
    split = node.split()
    left, right = _condition(node.leftChild()), _condition(node.rightChild())
    return f"CASE WHEN {{x}}[{split.featureIndex()}] <= {split.threshold()!r}D THEN {left} ELSE {right} END"


def fit(docs: DataFrame, text: str = "text") -> SpanModel:
    """Fit trees on two thirds of the texts, calibrate thresholds on the last third, both on all their candidates.

    A generator's threshold is the least score bin from which on its precision on the last
    third is at least ``MIN_PRECISION``, over ``MIN_POSITIVE`` right ones or more. Without rows of both classes nothing is added.
    """
    rows = written(training_rows(docs, text).sortWithinPartitions("part", "generator", "y", "x"))
    train, rest = rows.where("part > 0"), rows.where("part = 0")
    sizes = train.agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).first()
    if not sizes[1] or sizes[1] == sizes[0] or sizes[0] < 50:
        return NO_MODEL
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, maxBins=MOST_BINS, stepSize=0.3, seed=1, cacheNodeIds=False, weightCol="weight").fit(
        train.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), F.col("n").cast("double").alias("weight"))
    )
    trees = [
        f"{weight!r}D * ({_condition(tree._call_java('rootNode'))})"
        for tree, weight in zip(model.trees, model.treeWeights)
    ]
    fitted = SpanModel(" + ".join(trees), ())
    bins = rest.select("generator", "y", "n", F.expr(f"floor(({fitted.score('x')}) * 100)").alias("bin")).groupBy("generator", "bin").agg(
        F.sum(F.col("n") * F.col("y")).alias("good"), F.sum("n").alias("n")
    )
    above = Window.partitionBy("generator").orderBy(F.col("bin").desc())
    reached = bins.withColumns({"_good": F.sum("good").over(above), "_n": F.sum("n").over(above)}).where(
        (F.col("_good") >= MIN_PRECISION * F.col("_n")) & (F.col("_good") >= MIN_POSITIVE) & (F.col("bin") >= 50)
    )
    found_at = {r.generator: r.bin / 100 for r in reached.groupBy("generator").agg(F.min("bin").alias("bin")).collect()}
    return SpanModel(fitted.margin, tuple(float(found_at.get(g, 2.0)) for g in range(len(GENERATORS))))


def with_spans(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` (start, end, kind number), both sorted by start, then kind.

    ``spans`` holds the base spans, what the base rules find between them, and the candidates
    between all those that are over their generator's threshold and overlap no better one.
    Null texts count as empty. Columns of these names are replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    place = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    own = [c for c in docs.columns if c not in ("base", "spans", "_c", "_t", "_left")]
    by_place = lambda a, b: F.when(
        (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1).otherwise(1)
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>")
    rows = (
        docs.select(*own, F.transform(base_spans(value), place).alias("base"))
        .withColumn("_t", masked(value, disjoint(F.col("base"))))
        # What a base rule failed on may hold once another span is cut out of it.
        .withColumn("_left", F.when(F.size("base") > 0, F.transform(base_spans(F.col("_t")), place)).otherwise(no_spans))
        .withColumn("_t", masked(F.col("_t"), disjoint(F.col("_left"))))
    )
    if min(model.thresholds) > 1:
        return rows.withColumn("spans", F.array_sort(F.concat("base", "_left"), by_place)).drop("_t", "_left")
    limits = ", ".join(f"{t!r}D" for t in model.thresholds)
    scored = F.expr(
        f"filter(transform(_c, c -> struct(c.start, c.end, c.kind, {model.score('c.x')} AS score, c.generator)),"
        f" c -> c.score >= array({limits})[c.generator])"
    )
    return (
        rows.withColumn("_c", candidates(F.col("_t"))).withColumn("_c", scored)
        .withColumn("_c", F.when(F.size("_c") > 0, F.transform(best_apart(F.array_sort("_c")), place)).otherwise(no_spans))
        .withColumn("spans", F.array_sort(F.concat("base", "_left", "_c"), by_place))
        .drop("_c", "_t", "_left")
    )


def best_apart(scored: Column) -> Column:
    """Of sorted candidates that overlap in turn the one of the greatest score, ties to the earlier."""
    element = "struct<start:bigint,end:bigint,kind:int,score:double,generator:int>"

    def step(open_: Column, c: Column) -> tuple[Column, Column]:
        apart = open_.isNull() | (c["start"] >= open_["end"])
        return F.when(apart | (c["score"] > open_["score"]), c).otherwise(open_), F.when(apart, open_)

    whole = scanned(scored, F.lit(None).cast(element), element, step)
    return bound(whole, lambda z: F.filter(F.concat(z["out"], F.array(z["carry"])), lambda s: s.isNotNull()))


def joined(spans: str) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with counts and digests of their spans.

    Every row is kept; null and empty texts have no spans. An empty table gives no rows.
    """
    rows = with_spans(docs, fit(docs, text), text)
    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = {f"n_{kind}": count(number) for number, kind in enumerate(KINDS)}
    return rows.withColumns(counts | {
        "base_sha256": F.sha2(joined("base").cast("binary"), 256), "spans": joined("spans"),
    }).drop("base")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in capitals and brackets.

    Overlapping spans are one replacement, named after the first. ``n_chars`` follows the
    text where there is such a column. Texts without spans, null ones too, stay as they are.
    """
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    inner = shielded(docs, (text, "n_chars"))
    rows = with_spans(inner, fit(docs, text), text)
    whole = replaced(F.col(text), F.col("spans"), lambda s: F.get(marks, s["kind"]))
    out = rows.withColumn(text, F.when(F.size("spans") > 0, whole).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.char_length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return restored(out, inner, docs)
