"""Secret scans by a battery of randomness tests (dealt operator 2, native).

Base spans, leftmost and non-overlapping by kind, are three patterns: assignments, access keys and
hexadecimal runs. The method adds ``random`` spans: tokens of ``TOKEN`` that look drawn at random from their
alphabet.

For each token an encoding is inferred, the narrowest of its alphabets (decimal, hexadecimal, base 32,
alphanumeric, base 64), and three statistics are tested against draws from it: the chi-squared statistic of
the character counts and, as its coarsest cells have the most power, of the digits' share; the number of runs
above and below the alphabet's middle; and the serial correlation of neighbouring characters. Their z scores
are combined into one p-value (the least of the four, corrected for four looks). The hypothesis of randomness is what most tokens, being words or numbers, must be
able to lose, and short ones cannot; so the false-discovery rate is controlled among the tokens called *not
random* at ``LEVEL`` by a weighted Benjamini-Hochberg rule over all tokens of the corpus, with weights that grow
with a token's information (length times bits of its alphabet) and average 1. The tokens that keep their
randomness and carry ``INFORMATION`` bits or more, of two character classes at least, are the random spans.

The rule needs only the counts of tokens by p-value step and weight class, a table of bounded size,
aggregated before it reaches the driver; the scan then is one pass without a shuffle.

Rules for odd input: null or empty text has no spans; positions count code points, ends are exclusive; equal
rows give equal results; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in the order of listing, each with what its match must hold.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
#: Alphabets from narrow to wide: their characters in order, and the pattern of their strings.
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "decimal": (DIGITS, r"^[0-9]+$"),
    "hex": (DIGITS + "abcdef", r"^[0-9a-f]+$"),
    "HEX": (DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    "lower": (LOWER, r"^[a-z]+$"),
    "upper": (UPPER, r"^[A-Z]+$"),
    "base32": (UPPER + DIGITS, r"^[A-Z0-9]+$"),
    "base36": (LOWER + DIGITS, r"^[a-z0-9]+$"),
    "letters": (UPPER + LOWER, r"^[A-Za-z]+$"),
    "base62": (UPPER + LOWER + DIGITS, r"^[A-Za-z0-9]+$"),
    "base64": (UPPER + LOWER + DIGITS + "+/-_", r"^[A-Za-z0-9+/_-]+$"),
}
LEVEL = 0.05
INFORMATION = 72.0
STEP = 20  # p-value steps to a factor of ten
STEPS = 400
CLASS_BITS = 16.0  # weight classes of so many bits of information
CLASSES = 32
KINDS = ("assign", "access", "hex", "random")
_SPAN = "array<struct<start:int,end:int,value:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, value): the gaps between them and the matches
    themselves, measured in code points. Most texts have no match and are searched once."""
    none = F.array().cast(_SPAN)
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(hits, F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    # after the last match one gap is left over
    found = F.aggregate(F.filter(pairs, lambda p: p["hit"].isNotNull()), zero, add, lambda s: s["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the three base kinds. An assignment is matched first and dropped after, for its match
    hides later ones; a shorter run of the other kinds hides nothing, so it is not looked for."""
    return {
        "assign": F.filter(_spans(text, ASSIGN), lambda s: F.char_length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= 6),
        "access": F.filter(_spans(text, ACCESS), lambda s: F.char_length(s["value"]) >= 20),
        "hex": _spans(text, HEX),
    }


def _tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by a logistic approximation (error below 2e-4)."""
    cubic = 1.5976 * z + 0.07056 * z * z * z
    return 1 / (1 + F.exp(F.least(F.greatest(cubic, F.lit(-80.0)), F.lit(80.0))))


def _moments(x: Column, n: Column, k: Column, digits: Column, of_digits: Column) -> Column:
    """The z scores of the places x of n characters, some of them digits, in an alphabet of k."""
    pairs = F.zip_with(F.slice(x, F.lit(1), n - 1), F.slice(x, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    counts = F.transform(F.sequence(F.lit(0), k - 1), lambda c: F.size(F.filter(x, lambda v: v == c)).cast("double"))
    chi = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * k / n - n
    # the statistic's exact mean k - 1 and variance under uniform draws
    uneven = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    upper = F.floor((k + 1) / 2) / k
    change = 2 * upper * (1 - upper)
    changes = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + ((p["a"] * 2 < k) != (p["b"] * 2 < k)).cast("double"))
    runs = (changes - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change))
    middle = (k - 1) / 2
    product = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - middle) * (p["b"] - middle))
    serial = product / ((k * k - 1) / 12 * F.sqrt(n - 1))
    share = of_digits / k
    apart = F.when((share > 0) & (share < 1), (digits - n * share) / F.sqrt(n * share * (1 - share))).otherwise(0.0)
    return F.struct(uneven.alias("uneven"), apart.alias("digits"), runs.alias("runs"), serial.alias("serial"))


def judge(token: Column) -> Column:
    """(bits, p, mixed) of a token: its information under its inferred alphabet, the p-value of being
    random draws from it, and whether it has both letters and digits."""

    def digits(string: Column) -> Column:
        return F.char_length(string) - F.char_length(F.regexp_replace(string, "[0-9]", ""))

    def scored(s: Column) -> Column:
        n, k = F.char_length(s["body"]), F.char_length(s["letters"])
        x = F.transform(F.filter(F.split(s["body"], ""), lambda c: c != ""), lambda c: F.position(c, s["letters"]) - 1)
        return _let(
            _let(x, lambda v: _moments(v, n, k, digits(s["body"]), digits(s["letters"]))),
            lambda z: F.struct(
                (n * F.log2(k.cast("double"))).alias("bits"),
                F.least(F.lit(1.0), 4 * F.least(_tail(z["uneven"]), *[2 * _tail(F.abs(z[c])) for c in ("digits", "runs", "serial")])).alias("p"),
                (F.regexp_like(s["body"], F.lit("[0-9]")) & F.regexp_like(s["body"], F.lit("[A-Za-z]"))).alias("mixed"),
            ),
        )

    def named(body: Column) -> Column:
        letters = F.coalesce(*[F.when(F.regexp_like(body, F.lit(pattern)), F.lit(chars)) for chars, pattern in ALPHABETS.values()])
        return _let(F.struct(body.alias("body"), letters.alias("letters")), scored)

    return _let(F.regexp_replace(token, "=+$", ""), named)


def _class(bits: Column) -> Column:
    return F.least(F.floor(bits / CLASS_BITS), F.lit(CLASSES - 1)).cast("int")


def _step(p: Column) -> Column:
    """p in steps; a step stands for its largest p, so the rule errs to the safe side."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEP + 1e-9), F.lit(STEPS)).cast("int")


def thresholds(table: list[tuple[int, int, int, float]]) -> list[int]:
    """For each weight class the p-value step from which on a token is called not random, by the weighted
    Benjamini-Hochberg rule. ``table``: class, step, tokens, their bits in sum."""
    tokens = sum(n for _, _, n, _ in table)
    count, total = [0] * CLASSES, [0.0] * CLASSES
    for c, _, n, bits in table:
        count[c] += n
        total[c] += bits
    mean = sum(total) / max(1, tokens)
    weight = [total[c] / count[c] / mean if count[c] else 1.0 for c in range(CLASSES)]

    def steps(level: int) -> list[int]:
        return [max(0, math.ceil(level - STEP * math.log10(w) - 1e-9)) for w in weight]

    for level in range(STEPS + 1):  # from the most rejections to the fewest
        at = steps(level)
        rejected = sum(n for c, s, n, _ in table if s >= at[c])
        if tokens * 10 ** (-level / STEP) <= LEVEL * rejected:
            return at
    return [STEPS + 1] * CLASSES


def _tokens(text: Column) -> Column:
    return F.transform(_spans(text, TOKEN), lambda s: F.struct(s["start"], s["end"], judge(s["value"]).alias("judged")))


def control(docs: DataFrame) -> list[int]:
    """``thresholds`` of all tokens of all documents."""
    judged = docs.select(F.explode(_tokens(F.col("text"))["judged"]).alias("j"))
    table = judged.groupBy(_class(F.col("j.bits")).alias("c"), _step(F.col("j.p")).alias("s")).agg(F.count("*").alias("n"), F.sum("j.bits").alias("bits"))
    return thresholds([tuple(r) for r in table.collect()])  # CLASSES * STEPS rows at most


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``assign``, ``access``, ``hex`` and ``random`` of spans (start, end)."""
    limit = F.array(*[F.lit(x) for x in control(docs)])
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in docs.columns if c not in KINDS]
    base = {k: F.transform(v, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k, v in base_spans(text).items()}
    found = docs.select(*kept, *[v.alias(k) for k, v in base.items()], _tokens(text).alias("_tokens"))
    known = F.concat(*[F.col(k) for k in base])

    def is_random(t: Column) -> Column:
        j = t["judged"]
        quiet = _step(j["p"]) < F.element_at(limit, _class(j["bits"]) + 1)
        new = ~F.exists(known, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        return quiet & (j["bits"] >= INFORMATION) & j["mixed"] & new

    random = F.transform(F.filter("_tokens", is_random), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return found.select(*kept, *base, random.alias("random"))


def listed(*kinds: str) -> Column:
    """kind:start:end of the kinds' spans by start, then kind as listed, joined by commas."""

    def rows(place: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("text")))

    spans = F.concat(*[rows(i, k) for i, k in enumerate(kinds)])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda r: r["text"]))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the base kinds' counts, their digest and all spans."""
    found = scan(docs.select("doc_id", "text"))
    count = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(listed(*KINDS[:3]), 256).alias("base_sha256"), listed(*KINDS).alias("spans"))


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
