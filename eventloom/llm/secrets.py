"""Secret scans in DataFrame functions only: fixed patterns, and a battery of randomness tests on other strings.

Candidates are runs of key characters; the smallest alphabet that holds one (hex, base32, base36, base64) is its encoding.
Each gets three tests of randomness over that encoding's alphabet: chi-squared uniformity of its symbols, runs
above and below the middle of the alphabet, and lag-1 serial correlation. Their p-values are combined by Cauchy's rule, which
holds for tests that depend on each other (runs and serial correlation do, by -0.7).

False discoveries are controlled twice, by Benjamini-Hochberg over all candidates of an encoding and length class, so that longer
strings and wider alphabets, which separate better, don't pay for the others. First over the battery's p-values: of the
strings that it finds not to be random, a hundredth may be random ones. Then, over the p-values of ordinary text for what the
battery leaves: the odds of a random string against ordinary ones (common letters, few digits, or the other styles).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chosen, cut, running_sums, text_or_empty

# Fixed patterns of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: kind: pattern of all matches, least code points of what is kept (of group 2 for assign).
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")

#: A run of key characters, long enough for the tests to tell anything.
#: '=' is no part of one but as padding at its end, so the value of KEY=VALUE stands alone.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?"
#: Encoding: its alphabet in order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base32_lower": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36_upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Per mille of letters a-z in words, about the mean of English, German, French and Spanish, none below 4.
LETTERS = (90, 15, 31, 43, 149, 13, 16, 25, 70, 4, 5, 47, 25, 79, 62, 20, 5, 66, 69, 72, 37, 12, 10, 4, 8, 6)
#: How ordinary strings mix upper case, lower case, digits, + and /: words, capitals, mixed case, words with numbers, numbers.
STYLES = ((0.12, 0.76, 0.07, 0.05), (0.76, 0.12, 0.07, 0.05), (0.42, 0.42, 0.10, 0.06), (0.25, 0.25, 0.45, 0.05), (0.02, 0.02, 0.91, 0.05))
#: Ordinary hex is words or numbers, not both in like parts.
HEX_STYLES = ((0.48, 0.47, 0.05, 0.0), (0.03, 0.02, 0.95, 0.0))


#: In ordinary strings a symbol is of the class (of these four) of the one before with this chance, and drawn anew otherwise.
STAY = 0.6


def symbol_classes(alphabet: str) -> list[int]:
    return [0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in alphabet]


def log_odds(alphabet: str) -> list[tuple[list[float], list[float]]]:
    """For each style, by symbol: the log of how much likelier it is in a random string than in an ordinary one, and what a symbol of the same class before it takes off that."""
    classes = symbol_classes(alphabet)
    common = [LETTERS[ord(c.lower()) - ord("a")] if c.isalpha() else 1 for c in alphabet]
    whole = [sum(w for w, of in zip(common, classes, strict=True) if of == k) for k in range(4)]

    def odds(upper: float, lower: float, digits: float, other: float) -> tuple[list[float], list[float]]:
        share = [upper, lower, digits, other] if whole[0] and whole[1] else [upper + lower, upper + lower, digits, other]
        held = sum(s for s, w in zip(share, whole, strict=True) if w)
        alone = [math.log(held * whole[k] / (share[k] * w * len(alphabet))) for k, w in zip(classes, common, strict=True)]
        return alone, [math.log(STAY * held / share[k] + 1 - STAY) for k in classes]

    return [odds(*style) for style in (HEX_STYLES if len(alphabet) == 16 else STYLES)]


#: Share of wrong ones among strings that the battery rejects, and among those that are reported.
FALSE_REJECTIONS, FALSE_DISCOVERIES = 0.01, 0.01
#: A test's p-value counts as this at most where it is combined: one perfect fit must not outweigh the other tests.
LARGEST_P = 0.9
#: Upper ends of the length classes.
LENGTH_CLASSES = (24, 32, 40, 64, 1 << 30)
#: p-values are counted in bins of a 20th of a decade down to 1e-50.
BINS_PER_DECADE, MOST_DECADES = 20, 50


#: Array of a pattern's matches: start in code points from 0, and text.
MATCHES = "array<struct<start:int,text:string>>"


def with_matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds, under each name, all leftmost non-overlapping matches of its pattern in the column text.

    Step by step, each on columns that the one before has made, so that no pattern is evaluated again inside a loop: a text
    without matches is searched once for each pattern, one with matches is also split by it.
    """
    found, steps, ends = (lambda k: F.col(f"__found_{k}")), (lambda k: F.col(f"__steps_{k}")), (lambda k: F.col(f"__ends_{k}"))
    some = lambda k, x: F.when(F.size(found(k)) > 0, x)
    out = df.withColumns({f"__found_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    out = out.withColumns({f"__steps_{k}": some(k, F.zip_with(F.slice(F.split(text, p, -1), 1, F.size(found(k))), found(k), lambda g, hit: F.length(g) + F.length(hit))) for k, p in patterns.items()})
    out = out.withColumns({f"__ends_{k}": some(k, running_sums(steps(k))) for k in patterns})
    placed = lambda k: F.zip_with(ends(k), found(k), lambda end, hit: F.struct((end - F.length(hit)).alias("start"), hit.alias("text")))
    return out.select(*df.columns, *[F.coalesce(some(k, placed(k)), F.array().cast(MATCHES)).alias(k) for k in patterns])


#: The longest runs of the last two kinds are their matches, so a least length in the pattern drops the same ones.
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


def base_spans() -> Column:
    """array<struct<start, kind (place in KINDS), end>> of the three fixed kinds, from columns of their matches."""

    def spans(kind: str, length) -> Column:
        kept = F.filter(kind, lambda m: length(m["text"]) >= LEAST[kind])
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (m["start"] + F.length(m["text"])).alias("end")))

    value = lambda t: F.length(F.regexp_extract(t, "^" + ASSIGN + "$", 2))
    return F.concat(spans("assign", value), spans("access", F.length), spans("hex", F.length))


def infer_encoding(token: Column) -> Column:
    """The smallest alphabet that holds all symbols; in those without + and /, hyphens and the like only part groups."""
    body = F.regexp_replace(token, "=+$", "")
    plain = F.translate(body, "-_+/", "")
    held = lambda symbols: plain.rlike(f"^[{symbols}]+$")
    return (
        F.when(held("0-9a-f"), "hex").when(held("0-9A-F"), "hex_upper")
        .when(held("A-Z2-7"), "base32").when(held("a-z2-7"), "base32_lower")
        .when(held("0-9a-z"), "base36").when(held("0-9A-Z"), "base36_upper")
        .otherwise("base64")
    )


def two_sided(z: Column) -> Column:
    """The chance that a normal value is further from 0 than z: the complementary error function by a rational approximation (error 1.5e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = F.lit(1.0) / (x * 0.3275911 + 1)
    # Fixed values of the approximation.
    poly = t * (t * (t * (t * (t * 1.061405429 - 1.453152027) + 1.421413741) - 0.284496736) + 0.254829592)
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def cauchy(ps: list[Column]) -> Column:
    """One p-value from those of tests that may depend on each other."""
    mean = sum((F.tan((0.5 - F.least(p, F.lit(LARGEST_P))) * math.pi) for p in ps), F.lit(0.0)) / len(ps)
    return F.greatest(0.5 - F.atan(mean) / math.pi, F.lit(10.0 ** -MOST_DECADES))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds to rows with token, encoding: chi2, the z of the three tests, their p-values combined (p_random: a random string
    looks this unlike one), and p (ordinary text looks this random)."""
    chosen = lambda what: F.coalesce(*[F.when(F.col("encoding") == k, F.lit(what(v))) for k, v in ALPHABETS.items()])
    body = F.translate(F.regexp_replace("token", "=+$", ""), "-_", "+/")
    with_codes = tokens.withColumns({
        "k": chosen(lambda a: float(len(a))), "alphabet": chosen(lambda a: a), "class_of": chosen(symbol_classes),
        "alone": chosen(lambda a: [x for x, _ in log_odds(a)]), "after": chosen(lambda a: [x for _, x in log_odds(a)]),
    }).withColumn("codes", F.transform(F.split(body, ""), lambda c: F.when(c == "", F.lit(-1)).otherwise(F.instr(F.col("alphabet"), c) - 1))).withColumn("codes", F.filter("codes", lambda c: c >= 0)) \
        .withColumn("n", F.size("codes").cast("double"))
    counts = F.transform(F.array_distinct("codes"), lambda v: F.size(F.filter("codes", lambda c: c == v)).cast("double"))
    expected = F.col("n") / F.col("k")
    chi2 = F.aggregate(counts, F.lit(0.0), lambda s, o: s + o * o / expected) - F.col("n")
    sides = F.transform("codes", lambda c: (c * 2 >= F.col("k")).cast("int"))
    pairs = lambda a: F.arrays_zip(F.slice(a, 1, F.size(a) - 1).alias("x"), F.slice(a, 2, F.size(a) - 1).alias("y"))
    middle = (F.col("k") - 1) / 2
    tested = with_codes.where("n >= 2").withColumns({
        "chi2": chi2,
        "high": F.aggregate(sides, F.lit(0), lambda s, b: s + b).cast("double"),
        "runs": F.aggregate(pairs(sides), F.lit(1), lambda s, p: s + (p["x"] != p["y"]).cast("int")).cast("double"),
        "lagged": F.aggregate(pairs(F.col("codes")), F.lit(0.0), lambda s, p: s + (p["x"] - middle) * (p["y"] - middle)),
    })
    n, k = F.col("n"), F.col("k")
    low_side = n - F.col("high")
    mean_runs = F.col("high") * low_side * 2 / n + 1
    var_runs = F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9))
    var_code = (k * k - 1) / 12
    # Sparse cells: the variance of X^2 under uniformity is exactly 2 (k - 1)(n - 1) / n.
    chi_z = (F.col("chi2") - (k - 1)) / F.sqrt((k - 1) * 2 * (n - 1) / n)
    # Under a style the odds of a string exceed x with a chance of 1 / x at most (Markov), so those of its likeliest style bound p.
    same = lambda p: F.get("class_of", p["x"]) == F.get("class_of", p["y"])
    drawn = F.transform("alone", lambda style: F.aggregate("codes", F.lit(0.0), lambda s, c: s + F.get(style, c)))
    followed = F.transform("after", lambda style: F.aggregate(pairs(F.col("codes")), F.lit(0.0), lambda s, p: s + F.when(same(p), F.get(style, p["y"])).otherwise(math.log(1 - STAY))))
    odds = F.array_min(F.zip_with(drawn, followed, lambda a, b: a - b))
    return tested.withColumns({
        "runs_z": (F.col("runs") - mean_runs) / F.sqrt(var_runs),
        "serial_z": F.col("lagged") / (var_code * F.sqrt(n - 1)),
        "chi_z": chi_z,
        "p": F.exp(-F.greatest(odds, F.lit(0.0))),
    }).withColumn("p_random", cauchy([two_sided(F.col(z)) for z in ("chi_z", "runs_z", "serial_z")]))


def length_class(n: Column) -> Column:
    return F.coalesce(*[F.when(n <= top, F.lit(c)) for c, top in enumerate(LENGTH_CLASSES)])


def passing(rows: DataFrame, p: Column, rate: float, name: str) -> DataFrame:
    """Adds name: whether p passes Benjamini-Hochberg at rate among the rows of its encoding and length class.

    p-values are ranked by bins, so the table of counts stays small.
    """
    most = BINS_PER_DECADE * MOST_DECADES
    lowest = F.greatest(p, F.lit(10.0 ** -MOST_DECADES))
    binned = rows.withColumns({"class": length_class(F.col("n")), "bin": F.floor(-F.log10(lowest) * BINS_PER_DECADE).cast("int")})
    counts = binned.groupBy("encoding", "class", "bin").agg(F.count(F.lit(1)).alias("here"))  # at most encodings x classes x bins rows
    in_class = Window.partitionBy("encoding", "class")
    ranked = counts.withColumns({"rank": F.sum("here").over(in_class.orderBy(F.desc("bin"))), "m": F.sum("here").over(in_class)})
    # A bin holds p-values up to 10^(-bin / per decade); the least bin whose upper end is below rank / m x rate passes.
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= F.col("rank") / F.col("m") * rate)
    least = passed.groupBy("encoding", "class").agg(F.min("bin").alias("least")).where(F.col("least") <= most)
    return binned.join(F.broadcast(least), ["encoding", "class"], "left").withColumn(name, F.coalesce(F.col("bin") >= F.col("least"), F.lit(False))).drop("class", "bin", "least")


def discoveries(tested: DataFrame, rate: float = FALSE_DISCOVERIES, rejections: float = FALSE_REJECTIONS) -> DataFrame:
    """Adds rejected (the battery finds the string not random) and found (the string is reported), each controlled in its class."""
    judged = passing(tested, F.col("p_random"), rejections, "rejected")
    # A candidate that isn't random counts among the candidates of its class with p = 1.
    return passing(judged, F.when(F.col("rejected"), F.lit(1.0)).otherwise(F.col("p")), rate, "found")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: row_no, doc_id, spans array<struct<start, kind, end>> in order of start, then kind.

    kind is the place in KINDS; code points from 0, end exclusive. Null text counts as empty, rows may repeat and ids
    may be null; each row is judged by itself, but for the threshold of random strings, which all texts share.
    An empty table gives no rows. Where the method finds a string that a fixed pattern covers at the same place, only the fixed span is given.
    """
    wide = "array<struct<start:int,kind:int,end:int>>"
    rows = chosen(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row_no"), "doc_id", text_or_empty("text").alias("text"))
    # The encoding is stored with its candidate: the battery's loops over symbols would infer it again at each.
    tokens = F.transform("candidates", lambda m: F.struct(m["start"].alias("start"), m["text"].alias("text"), infer_encoding(m["text"]).alias("encoding")))
    matched = with_matches(rows, "text", PATTERNS | {"candidates": CANDIDATE})
    scanned = cut(matched.select("row_no", "doc_id", base_spans().cast(wide).alias("base"), tokens.alias("tokens")), "spans")
    single = scanned.where(F.size("tokens") > 0).select("row_no", F.explode("tokens").alias("t")).select(
        "row_no", F.col("t.start").alias("start"), F.col("t.text").alias("token"), F.col("t.encoding").alias("encoding")
    )
    # The few numbers that are left of a candidate are stored: both thresholds count them, and the battery is the dear part.
    tested = cut(battery(single).select("row_no", "start", F.length("token").alias("size"), "encoding", "n", "p_random", "p"), "tested")
    found = discoveries(tested).where("found").groupBy("row_no").agg(
        F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("kind"), (F.col("start") + F.col("size")).alias("end"))).cast(wide).alias("more")
    )
    empty = F.array().cast(wide)
    joined = scanned.join(found, "row_no", "left").withColumn("more", F.coalesce("more", empty))
    fresh = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    return joined.select("row_no", "doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", fresh)).alias("spans"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )
