"""Personal data: fixed patterns as seeds, and identifiers found through the company seeds keep.

Seeds are the e-mail addresses, IP addresses, card and phone numbers that fixed patterns find, and credentials: tokens
assigned to a name of NAMES. Candidates are other tokens with a digit, and runs of up to five short groups of digits.
Every seed and candidate is an instance. The patterns it shows are lexical: the word to its left with the punctuation
between, the two words to its left, the words around it; and its shape (digits, letters, punctuation) alone and after
the word to its left. A context without shape reaches values that are written like no seed.

Patterns and instances form a graph that is scored in rounds, per kind. A pattern is as sure as a lower confidence bound
of the share of its instances that are seeds, or that were accepted through another pattern: its own score is no evidence
for it. All others count against it, values that failed the kind's check among them. Candidates of a pattern above the
threshold are accepted if they could be of the kind at all (a card's digits still pass Luhn, a phone has 7 to 15 digits).
The next round starts from seeds and accepted instances, so these promote patterns that no seed shows. In the end accepted
candidates become spans, and so does a candidate that is a seed elsewhere. Base spans stay as they are.

Everything is scanned once and written; the graph then needs only the instances. Counts per pattern are sums, aggregated
before they are shuffled; where patterns meet instances, each pattern is dealt to SALTS tasks, so one that a third of all
rows show has no task of its own.

The patterns are written so that a failing start is given up in one step (possessive loops, starts only
where a run begins): texts of any length are scanned in linear time, without recursion. The surroundings of instances
are cut from pieces of the text, as reaching into a long text is a walk from its start.

Defined results: NULL and empty texts have no spans; repeated rows give repeated results; of several kinds for one value
a seed's comes first, then that of the surest pattern.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.llm.tables import SPANS, all_gathered, gathered, match_spans, nothing_gathered, texts
from strataload.session import materialize

KINDS = ["email", "ip", "card", "phone"]

# Equal in what they match to the kinds' definitions; written without backtracking.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[0-9]|[\x20-](?=[0-9]))++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GROUP = r"\(?+[0-9]{1,6}+(?:[)./-]++\(?+[0-9]{1,6}+)*+\)?+"
TOKEN = (
    rf"(?<![A-Za-z0-9@._+-])(?:{_GROUP}(?:\x20{_GROUP}){{0,4}}+(?![A-Za-z0-9@_]|[.+-][A-Za-z0-9])"
    r"|[A-Za-z@._+-]*+[0-9][A-Za-z0-9@._+-]*+)"
)
GATES = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"

# What credentials are assigned to.
NAMES = ["token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "auth_token", "private_key"]
SECRET = len(KINDS)  # the kind of credentials, after the base kinds
ALL_KINDS = [*KINDS, "secret"]

PIECE, MARGIN = 4096, 64  # code points

ROUNDS = 3
ACCEPT = 0.5
BOUND = 1.64  # standard deviations that a pattern's score lies below the share it has
MIN_SEEDS = 3
SALTS = 16


def _luhn(digits: Column) -> Column:
    """The digits from the right, every second one doubled, add up to a multiple of ten."""
    reverse = F.reverse(digits)

    def add(total, i):
        d = F.substring(reverse, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"\A{_PART}(?:\.{_PART}){{3}}\z"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _seeds(kind: str) -> Column:
    number = KINDS.index(kind)
    checked = F.filter(match_spans(F.col("text"), PATTERNS[kind]), lambda m: _holds(kind, m["match"]))
    spans = F.transform(
        checked,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(number).alias("kind"),
            m["end"].alias("end"),
            m["match"].alias("value"),
        ),
    )
    gate = F.col("digits")
    if kind == "email":
        gate = F.contains("text", F.lit("@"))
    elif GATES[kind]:
        gate = gate & F.contains("text", F.lit(GATES[kind]))
    return F.when(gate, spans).otherwise(F.array().cast(SPAN))


def _outside(base: Column, tokens: Column) -> Column:
    """The tokens that meet no span of ``base``, from one sweep over both in the order of their starts.

    Spans have a kind of 0 or more and tokens -1; of equal starts the span has to come first. Tokens do not meet each
    other, so only the last one can still meet a span that starts after it.
    """

    def entry(s, turn):
        return F.struct(s["start"].alias("start"), F.lit(turn).alias("turn"), s.alias("span"))

    entries = F.array_sort(
        F.concat(F.transform(base, lambda s: entry(s, 0)), F.transform(tokens, lambda s: entry(s, 1)))
    )

    def step(state, e):
        is_token = e["turn"] == 1
        span, held = e["span"], state["held"]
        met = held.isNotNull() & (span["start"] < held["end"]) & ~is_token
        # A token that is held is free once another token comes up.
        out = is_token & held.isNotNull()
        free = is_token & (span["start"] >= state["until"])
        none = F.lit(None).cast(SPAN[6:-1])
        return F.struct(
            F.when(is_token, state["until"]).otherwise(F.greatest(state["until"], span["end"])).alias("until"),
            F.when(free, span).when(is_token | met, none).otherwise(held).alias("held"),
            *gathered(state, held, out, SPAN),
        )

    begin = F.struct(F.lit(0).alias("until"), F.lit(None).cast(SPAN[6:-1]).alias("held"), *nothing_gathered(SPAN))

    def finish(state):
        rest = F.when(state["held"].isNull(), F.array().cast(SPAN)).otherwise(F.array(state["held"]))
        return F.concat(all_gathered(state), rest)

    return F.aggregate(entries, begin, step, finish)


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, instances): base spans by start and kind; seeds and candidates with the words around them."""
    rows = texts(docs).withColumn("digits", F.col("text").rlike("[0-9]"))
    for kind in KINDS:
        rows = rows.withColumn(kind, _seeds(kind))
    rows = rows.withColumn("base", F.array_sort(F.concat(*KINDS)))
    # Only tokens with a digit match: most words of most texts are none.
    tokens = F.filter(match_spans(F.col("text"), TOKEN), lambda m: F.length(m["match"]) >= 6)
    rows = rows.withColumn("tokens", F.when(F.col("digits"), tokens).otherwise(F.array().cast(SPANS)))

    def trimmed(m):
        # A full stop or dash that closes the token belongs to the sentence.
        value = F.regexp_replace(m["match"], r"[.@_+-]++\z", "")
        return F.struct(
            m["start"].alias("start"),
            F.lit(-1).alias("kind"),
            (m["start"] + F.length(value)).cast("int").alias("end"),
            value.alias("value"),
        )

    candidates = F.transform("tokens", trimmed)
    free = F.when(F.size("base") > 0, _outside(F.col("base"), candidates)).otherwise(candidates)
    found = F.concat("base", F.when(F.size("tokens") > 0, free).otherwise(F.array().cast(SPAN)))

    def around(t):
        before = _cut(t["start"] - 48, F.least(F.lit(48), t["start"]))
        after = _cut(t["end"], F.lit(24))
        near = r"(?:(\p{L}[\p{L}_]*+)[^\p{L}0-9]{1,8})?(\p{L}[\p{L}_]*+)([^\p{L}0-9]{0,8})\z"
        word = F.lower(F.regexp_extract(before, near, 2))
        glue = F.regexp_replace(F.regexp_extract(before, near, 3), r"\s", "")
        named = F.regexp_like(glue, F.lit(r"\A[\"']?[=:]")) & word.isin(NAMES)
        secret = (t["kind"] < 0) & named & _could_be(SECRET, t["value"])
        return F.struct(
            t["start"].alias("start"),
            F.when(secret, F.lit(SECRET)).otherwise(t["kind"]).alias("kind"),
            t["end"].alias("end"),
            t["value"].alias("value"),
            F.when(word != "", F.concat_ws(" ", word, glue)).alias("left"),
            F.lower(F.nullif(F.regexp_extract(before, near, 1), F.lit(""))).alias("left_2"),
            F.lower(F.nullif(F.regexp_extract(after, r"\A[^\p{L}0-9]{0,4}(\p{L}++)", 1), F.lit(""))).alias("right"),
        )

    # A piece holds the code points from PIECE times its number, and MARGIN more on both sides.
    numbers = F.sequence(F.lit(0), F.floor(F.length("text") / PIECE).cast("int"))
    cut = F.transform(
        numbers,
        lambda i: F.substring("text", F.greatest(F.lit(1), i * PIECE - MARGIN + 1), F.when(i > 0, PIECE + 2 * MARGIN).otherwise(PIECE + MARGIN)),
    )
    rows = rows.select("doc_id", "base", found.alias("found"), F.when(F.size(found) > 0, cut).alias("pieces"))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "base",
        F.transform("found", around).alias("instances"),
    )


def _cut(start: Column, length: Column) -> Column:
    """Up to MARGIN code points of the text from ``start``, from the piece that holds them."""
    start = F.greatest(F.lit(0), start)
    number = F.floor(start / PIECE).cast("int")
    at = start - number * PIECE + F.when(number > 0, MARGIN).otherwise(0)
    return F.substring(F.element_at("pieces", number + 1), (at + 1).cast("int"), length)


def _could_be(number: int, value: Column) -> Column:
    """A candidate, however it is written, has what every value of the kind has."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if number == SECRET:
        return F.regexp_like(value, F.lit(r"\A(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9+/_=.-]{16,}+\z"))
    kind = KINDS[number]
    if kind == "email":
        return F.regexp_like(value, F.lit(r"\A[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]++\z"))
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"\A{_PART}(?:[.-]{_PART}){{3}}\z"))
    if kind == "card":
        plain = F.regexp_like(value, F.lit(r"\A[0-9\x20./-]++\z"))
        return F.when(plain & F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.regexp_like(value, F.lit(r"\A[0-9\x20()./+-]++\z")) & F.length(digits).between(7, 15)


def shape(value: Column) -> Column:
    """Letters as a, digits as 9 with their number, punctuation as it is; long hex strings as hex."""
    digits = F.regexp_replace(value, "[0-9]", "9")
    plain = F.regexp_replace(F.regexp_replace(digits, "[A-Za-z]+", "a"), "9+", "9")
    return (
        F.when(F.regexp_like(value, F.lit(r"\A[0-9]+\z")), F.concat(F.lit("9x"), F.length(value).cast("string")))
        .when(F.regexp_like(value, F.lit(r"\A[0-9a-f]{16,}\z")), F.concat(F.lit("hex"), F.length(value).cast("string")))
        .otherwise(plain)
    )


def _failed(value: Column, as_kind: Column) -> Column:
    """The value is a match of the kind's pattern that its check turns down."""
    out = F.lit(False)
    for number, kind in enumerate(KINDS):
        whole = F.regexp_like(value, F.lit(rf"\A(?:{PATTERNS[kind]})\z"))
        out = F.when(as_kind == number, whole & ~_holds(kind, value)).otherwise(out)
    return out


def _sure(good: Column, n: Column) -> Column:
    """Lower end of the Wilson interval of good / n."""
    share, square = good / n, BOUND * BOUND
    spread = BOUND * F.sqrt(share * (1 - share) / n + square / (4 * n * n))
    return (share + square / (2 * n) - spread) / (1 + square / n)


def _patterns() -> Column:
    """The lexical patterns that an instance shows; those whose words are missing are left out."""
    form, left = shape(F.col("value")), F.col("left")
    return F.array_compact(
        F.array(
            F.concat(F.lit("shape "), form),
            F.concat(F.lit("left shape "), left, F.lit(" "), form),
            F.concat(F.lit("left "), left),
            F.concat(F.lit("left two "), F.col("left_2"), F.lit(" "), left),
            F.concat(F.lit("around "), left, F.lit(" _ "), F.col("right")),
        )
    )


def _accepts(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(value, pattern, as_kind, score) of the candidates that sure patterns hold and that could be of their kind."""
    allowed = F.lit(False)
    for number in range(len(ALL_KINDS)):
        allowed = F.when(F.col("as_kind") == number, _could_be(number, F.col("value"))).otherwise(allowed)
    dealt = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = edges.filter("kind < 0").select(
        "value", "pattern", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int").alias("salt")
    )
    held = salted.join(dealt, ["pattern", "salt"]).filter(allowed & ~_failed(F.col("value"), F.col("as_kind")))
    return held.select("value", "pattern", "as_kind", "score")


def _held_by_others(edges: DataFrame, held: DataFrame) -> DataFrame:
    """(pattern, as_kind) of each edge whose value was accepted through a pattern other than the edge's."""
    votes = held.groupBy("value", "as_kind").agg(F.count("*").alias("holders"))
    own = held.select("value", "pattern", "as_kind", F.lit(1).alias("own"))
    meeting = edges.filter("kind < 0").select("value", "pattern").join(votes, "value")
    return (
        meeting.join(own, ["value", "pattern", "as_kind"], "left")
        .filter(F.col("holders") - F.coalesce("own", F.lit(0)) > 0)
        .select("pattern", "as_kind")
    )


def discover(scanned: DataFrame) -> DataFrame:
    """(value, found) of values outside the base spans that are personal data, with the number of their kind."""
    occurrences = scanned.select(F.explode("instances").alias("i")).select("i.*")
    edges = materialize(
        occurrences.select("value", "kind", F.explode(_patterns()).alias("pattern"))
        .groupBy("value", "pattern")
        .agg(F.max("kind").alias("kind"), F.bool_or((F.col("kind") < 0) | (F.col("kind") == SECRET)).alias("free")),
        "pii-edges",
    )
    # Patterns with fewer instances than a score needs never score.
    totals = materialize(
        edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_SEEDS), "pii-totals"
    )
    seeds = edges.filter("kind >= 0").select("pattern", F.col("kind").alias("as_kind"))
    good = seeds
    for _ in range(ROUNDS):
        counts = good.groupBy("pattern", "as_kind").agg(F.count("*").alias("good")).filter(F.col("good") >= MIN_SEEDS)
        scores = counts.join(totals, "pattern").withColumn("score", _sure(F.col("good").cast("double"), F.col("n")))
        sure = scores.filter(F.col("score") >= ACCEPT).select("pattern", "as_kind", "score")
        held = materialize(_accepts(edges, sure), "pii-held")
        good = seeds.unionByName(_held_by_others(edges, held))
    known = (
        edges.groupBy("value")
        .agg(F.max("kind").alias("as_kind"), F.bool_or("free").alias("free"))
        .filter(F.col("free") & (F.col("as_kind") >= 0))
        .select("value", "as_kind", F.lit(2.0).alias("score"))
    )
    accepted = held.select("value", "as_kind", "score").unionByName(known)
    return accepted.groupBy("value").agg(F.max_by("as_kind", F.struct("score", "as_kind")).alias("found"))


def find_pii(docs: DataFrame) -> DataFrame:
    """Every document with its counts per kind and the spans of seeds and discovered identifiers."""
    scanned = materialize(scan(docs), "pii-scan")
    found = discover(scanned)
    extra = (
        scanned.select("row", F.explode("instances").alias("i"))
        .filter((F.col("i.kind") < 0) | (F.col("i.kind") == SECRET))
        .select("row", F.col("i.value").alias("value"), F.col("i.start").alias("start"), F.col("i.end").alias("end"))
        .join(found, "value")
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("start"), F.col("found").alias("kind"), F.col("end"), F.col("value")
                )
            ).alias("extra")
        )
    )
    rows = scanned.select("row", "doc_id", "base").join(extra, "row", "left")
    names = F.array(*map(F.lit, ALL_KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])),
            ",",
        )

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    everything = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(SPAN))))
    return rows.select(
        "doc_id",
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(everything).alias("spans"),
        F.size(F.coalesce("extra", F.array().cast(SPAN))).cast("long").alias("n_found"),
    )
