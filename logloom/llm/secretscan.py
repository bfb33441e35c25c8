"""Secret scan: fixed patterns, plus strings that look random to a pair of character Markov models.

Everything is SQL functions. A text is cut at a pattern's matches; running lengths of the pieces and matches give positions. Two first-order
Markov models, of random strings and of ordinary identifiers, are counted from labelled samples; a candidate's score is the sum of the
logarithms of the two probabilities' ratios over its neighbouring characters. Candidates are all whole runs of ``[A-Za-z0-9+/_.=-]`` of
``MIN_LENGTH`` characters or more; the ratio decides, against a threshold that grows with the square root of the length as the scatter of
the score does. Candidates that reach it and touch no base span are secrets of kind ``markov``.

Samples are what the fixed patterns find, every other long run in the texts, and :func:`known_samples`, made by rule: texts alone need not hold a date or a
path. A pair of characters that is rare in the samples counts by its classes (lower, upper, digit, sign). Models are fitted twice: ordinary samples that the
first ones take for random are left out of the second.

The model is a table of 128 x 128 numbers whatever the corpus; it travels as a constant of the query.

Defined cases: a null text is empty. Without samples of one class its model is uniform. Rows are independent; other columns are
not looked at; an empty table gives an empty result. Positions are code points, end exclusive.
"""

import json
import math
import random
import string
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.sources.durable import discard, durable

# The base patterns and their least lengths (of group 2, of the match, of the match).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "markov")

CLASS = "A-Za-z0-9+/_.=-"
MIN_LENGTH = 8
CANDIDATE = rf"(?<![{CLASS}])[{CLASS}]{{{MIN_LENGTH},}}"
#: A candidate of n characters is random from ``BASE + SLOPE * sqrt(n)`` on. ``SMOOTHING`` samples stand behind the classes of a pair.
BASE, SLOPE, SMOOTHING = 6.0, 1.0, 30.0
#: How many samples of each kind are made by rule, and their seed.
KNOWN, SEED = 3000, 7
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SPAN = "array<struct<start:int,ord:int,kind:string,end:int>>"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), group)


def _spans(text: Column, pattern: str, kind: str, keep=None, group: int = 0) -> Column:
    """Spans of the pattern's matches; ``keep`` is a test on what the group matched."""
    sought = F.struct(_matches(text, pattern).alias("hits"), _matches(text, pattern, group).alias("values"), F.transform(F.split(text, pattern, -1), F.length).alias("gaps"))

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.get(state["s"]["gaps"], i)
        end = start + F.length(F.get(state["s"]["hits"], i))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), F.lit(kind).alias("kind"), end.alias("end"))
        taken = F.array_append(state["spans"], span)
        if keep is not None:
            taken = F.when(keep(F.get(state["s"]["values"], i)), taken).otherwise(state["spans"])
        return F.struct(end.alias("at"), taken.alias("spans"), state["s"].alias("s"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"), sought.alias("s"))
    places = F.when(F.size(begin["s"]["hits"]) > 0, F.sequence(F.lit(0), F.size(begin["s"]["hits"]) - 1)).otherwise(F.array().cast("array<int>"))
    found = F.aggregate(places, begin, step, lambda state: state["spans"])
    # A text without a match is not cut at all.
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> list[Column]:
    """Spans of the three fixed patterns."""
    return [
        _spans(text, ASSIGN, "assign", lambda value: F.length(value) >= ASSIGN_LEAST, 2),
        F.when(text.contains("AKIA"), _spans(text, ACCESS, "access", lambda value: F.length(value) >= ACCESS_LEAST)).otherwise(F.array().cast(SPAN)),
        _spans(text, HEX, "hex"),
    ]


def labelled_samples(docs: DataFrame) -> DataFrame:
    """``sample, secret``: what the fixed patterns find, and every other long run of the alphabet in the texts of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    some = text.rlike(ASSIGN) | text.rlike(HEX) | text.contains("AKIA")
    values = F.concat(
        F.filter(_matches(text, ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_LEAST),
        F.filter(_matches(text, ACCESS), lambda v: F.length(v) >= ACCESS_LEAST),
        _matches(text, HEX),
    )
    rest = text
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    found = docs.select(
        F.when(some, values).otherwise(F.array().cast("array<string>")).alias("yes"), _matches(F.when(some, rest).otherwise(text), CANDIDATE).alias("no")
    )
    samples = F.array(F.struct(F.col("yes").alias("s"), F.lit(True).alias("secret")), F.struct(F.col("no").alias("s"), F.lit(False).alias("secret")))
    return found.select(F.explode(samples).alias("x")).select(F.explode("x.s").alias("sample"), F.col("x.secret").alias("secret"))


def known_samples(n: int = KNOWN, seed: int = SEED) -> list[tuple[str, bool]]:
    """``n`` random strings over usual alphabets, and ``n`` ordinary ones: dates, times, versions, numbers, addresses, paths, names in several styles."""
    draw = random.Random(seed)
    letters, digits = string.ascii_letters, string.digits
    alphabets = [letters, letters + digits, letters + digits, letters + digits + "+/", letters + digits + "-_", string.ascii_uppercase + digits, "0123456789abcdef"]
    made = [("".join(draw.choices(draw.choice(alphabets), k=draw.randrange(8, 48))), True) for _ in range(n)]
    # Words of usual names.
    words = (
        "account address admin archive backup batch bucket build cache client cluster column config connection content core created customer daily data "
        "database default deploy detail document download email engine error event export factory field file final full handler home image import index "
        "input instance invoice item java key lib library line list local log main manager master message meta method model module name network node "
        "number object order output package page path payment private process product profile project public python query queue record reference region "
        "release remote report request resource response result role root schema script search server service session setting shared source spark stage "
        "state status storage stream string system table target task temp template test text thread time tmp total type update upload user value var "
        "version view window worker"
    ).split()

    def number(low: int, high: int, width: int = 0) -> str:
        return str(draw.randrange(low, high)).zfill(width)

    def date(sign: str = "-") -> str:
        return sign.join([number(1990, 2040), number(1, 13, 2), number(1, 29, 2)])

    def name() -> str:
        parts = draw.choices(words, k=draw.randrange(1, 4))
        return draw.choice(["_".join(parts), "-".join(parts), ".".join(parts), parts[0] + "".join(p.title() for p in parts[1:]), "".join(p.title() for p in parts), "_".join(parts).upper()])

    rules = [
        date, lambda: date("/"), lambda: f"{date()}T{number(0, 24, 2)}", lambda: f"{name()}-{date()}.{draw.choice(words)}", lambda: f"{name()}_{date('')}",
        lambda: f"{name()}-{number(0, 30)}.{number(0, 30)}.{number(0, 30)}", lambda: f"v{number(0, 9)}.{number(0, 99)}.{number(0, 99)}-beta{number(1, 9)}",
        lambda: ".".join(number(0, 256) for _ in range(4)), lambda: number(10**7, 10**12), lambda: "0" * draw.randrange(8, 30) + number(0, 9), lambda: f"{number(1, 9999)}.{number(0, 10**6, 6)}",
        lambda: "/" + "/".join(name() for _ in range(draw.randrange(1, 5))), lambda: f"/{name()}/{name()}.{draw.choice(words)[:3]}", lambda: f"www.{name()}.com/{name()}",
        name, name, lambda: f"{name()}={name()}", lambda: f"{name()}{number(0, 1000)}", lambda: f"{name()}.tar.gz", lambda: f"{name()}=={number(0, 9)}.{number(0, 20)}.{number(0, 20)}",
        lambda: f"+{number(1, 99)}-{number(100, 999)}-{number(100, 999)}-{number(1000, 9999)}", lambda: draw.choice("-=_./") * draw.randrange(8, 40),
    ]
    return made + [(draw.choice(rules)(), False) for _ in range(n)]


def counted_pairs(samples: DataFrame) -> DataFrame:
    """``secret, pair, n``: how often two characters are neighbours in the samples (``sample, secret, n``) of a class."""
    pairs = samples.filter("length(sample) > 1").select("secret", "sample", "n", F.explode(F.expr("sequence(1, length(sample) - 1)")).alias("at"))
    counts = pairs.groupBy("secret", F.expr("substring(sample, at, 2)").alias("pair")).agg(F.sum("n").alias("n"))
    return counts.filter(F.col("pair").rlike(rf"\A[{CLASS}]{{2}}\z"))


def char_class(char: str) -> str:
    return "l" if char.islower() else "u" if char.isupper() else "d" if char.isdigit() else "s"


def ratios_of(counts: list[tuple[bool, str, int]]) -> list[float]:
    """Log-likelihood ratios by ``128 * first + second`` character code from how often two characters are neighbours in a class."""
    sizes = Counter(map(char_class, ALPHABET))
    seen: Counter = Counter()
    for secret, pair, n in counts:
        classes = char_class(pair[0]), char_class(pair[1])
        seen.update({(secret, pair): n, (secret, pair[0], ""): n, (secret, *classes, ""): n, (secret, classes[0], "", ""): n})

    def log_p(secret: bool, a: str, b: str) -> float:
        one, two = char_class(a), char_class(b)
        # A class after a class: the pair of classes, with a whole alphabet behind it; within a class all characters alike.
        by_class = (seen[secret, one, two, ""] + sizes[two] / len(ALPHABET)) / (seen[secret, one, "", ""] + 1.0) / sizes[two]
        return math.log((seen[secret, a + b] + SMOOTHING * by_class) / (seen[secret, a, ""] + SMOOTHING))

    ratios = [0.0] * (128 * 128)
    for a in ALPHABET:
        for b in ALPHABET:
            ratios[128 * ord(a) + ord(b)] = round(log_p(True, a, b) - log_p(False, a, b), 6)
    return ratios


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios by ``128 * first + second`` character code, from all rows of ``samples`` (``sample``, ``secret``).

    Characters outside the alphabet say nothing. The driver gets one row per class and pair of characters.
    """
    counts = counted_pairs(samples.groupBy("sample", "secret").agg(F.count(F.lit(1)).alias("n")))
    return ratios_of([(r["secret"], r["pair"], r["n"]) for r in counts.collect()])


def fit_twice(samples: DataFrame) -> list[float]:
    """:func:`fit` on samples and :func:`known_samples`, again without ordinary samples that the first models take for random.

    Samples by rule weigh as much as all others of their class together, so that the models do not depend on how much text there is.
    """
    spark = samples.sparkSession
    distinct = durable(samples.groupBy("sample", "secret").agg(F.count(F.lit(1)).alias("n")), "samples")
    by_rule = ratios_input(counted_pairs(spark.createDataFrame([(s, secret, 1) for s, secret in known_samples()], "sample string, secret boolean, n bigint")))
    first = ratios_of(balanced(ratios_input(counted_pairs(distinct)), by_rule))
    ordinary = distinct.filter(F.col("secret") | ~looks_random(F.col("sample"), constant(first)))
    ratios = ratios_of(balanced(ratios_input(counted_pairs(ordinary)), by_rule))
    discard(distinct)
    return ratios


def ratios_input(counts: DataFrame) -> list[tuple[bool, str, int]]:
    """At most one row per class and pair of characters."""
    return [(r["secret"], r["pair"], r["n"]) for r in counts.collect()]


def balanced(found: list[tuple[bool, str, int]], by_rule: list[tuple[bool, str, int]]) -> list[tuple[bool, str, float]]:
    """Both counts, scaled so that either has as many pairs of a class as the samples by rule have."""
    out = list(by_rule)
    for secret in (True, False):
        own, known = (sum(n for s, _, n in counts if s == secret) for counts in (found, by_rule))
        out += [(s, pair, n * known / own) for s, pair, n in found if s == secret]
    return out


def constant(ratios: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(ratios)), "array<double>")


def looks_random(value: Column, ratios: Column) -> Column:
    return log_ratio(value, ratios) >= F.lit(BASE) + F.lit(SLOPE) * F.sqrt(F.length(value))


def log_ratio(value: Column, ratios: Column) -> Column:
    """Sum of the ratios over neighbouring characters of ``value``."""
    codes = F.transform(F.split(value, ""), F.ascii)
    begin = F.struct(F.lit(0.0).cast("double").alias("sum"), F.lit(-1).alias("last"))

    def step(state: Column, code: Column) -> Column:
        inside = (state["last"] >= 0) & (state["last"] < 128) & (code < 128)
        gain = F.when(inside, F.get(ratios, state["last"] * 128 + code)).otherwise(0.0)
        return F.struct((state["sum"] + gain).alias("sum"), code.alias("last"))

    return F.aggregate(codes, begin, step, lambda state: state["sum"])


def scan(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``doc_id`` and the arrays ``base`` and ``spans`` of (start, ord, kind, end), both in order."""
    text = F.coalesce("text", F.lit(""))
    table = constant(ratios)
    # A text's distinct candidates are scored first; most texts have none that is random and are not cut.
    found = F.filter(F.array_distinct(_matches(text, CANDIDATE)), lambda value: looks_random(value, table))
    rows = docs.select("doc_id", text.alias("text"), F.array_sort(F.concat(*base_spans(text))).alias("base"), found.alias("found"))
    likely = _spans(F.col("text"), CANDIDATE, "markov", lambda value: F.array_contains("found", value))
    rows = rows.withColumn("likely", F.when(F.size("found") > 0, likely).otherwise(F.array().cast(SPAN)))
    apart = F.filter("likely", lambda m: ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Contract of the operator; the models learn from what the fixed patterns find in ``docs`` itself."""
    found = scan(docs, fit_twice(labelled_samples(docs)))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == "markov")).cast("bigint").alias("n_markov"),
    )
