"""Secret scans in DataFrame expressions only: base patterns, and a battery of randomness tests for other tokens.

Base patterns give spans of kinds assign, access and hex. Further candidates are runs of 20 or more characters
``[A-Za-z0-9+/_-]``, with the ``=`` that pad them, that no base span touches. A ``=`` before a run ends another one: in
``NAME=token`` and ``?key=token`` the token is judged alone. The battery infers each candidate's encoding, the smallest alphabet
with all of its symbols (hex, base32 and base36 in one case, base62, base64; base58 counts as base62), and tests it against
random characters of that alphabet:

- chi-squared uniformity, over the symbols and over the classes of symbols (digits, lower, upper case, others, and of the
  letters those that are rare in words),
- runs above and below the middle of the alphabet, and runs of digits and of other symbols (names keep digits together),
- serial correlation of neighbouring symbols.

Their Bonferroni-combined p-value says how badly a token fits randomness. A Benjamini-Hochberg step over all candidates of a
length band finds the ones that are significantly not random (ordinary identifiers, paths, words) at a false-discovery rate
of ``rate``; bands keep the many short candidates, whose tests are weak, from setting the limit for long ones. What is left
passes as random: a span of kind ``random``.

The step needs only counts per (band, bin of p): a table of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.shared import fresh

#: The base patterns.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
#: Groups of 6, 20 and 24 characters at least pass.
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: A whole run of 20 or more characters; inside a run the look-behind fails at once. ``=`` is padding only where no value follows.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:=++(?![A-Za-z0-9+/_-]))?"
RATE = 0.05
BAND, BANDS = 8, 12  # bands of 8 characters; the last is open
BINS, PER_DECADE = 120, 8
#: (name, symbols that a token in it has only, alphabet); the first that fits is a token's encoding. Words with a digit or none
#: count as base36, which expects more digits than base32.
ENCODINGS = [
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", "^(?=(.*[2-7]){3})([a-z2-7]+|[A-Z2-7]+)$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "^[A-Za-z0-9+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
#: Letters that words seldom have.
RARE = "bfgjkpqvwxyz"
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _matches(text: Column, possible: Column, pattern: str, kind: int, least: int = 1, group: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has ``least`` characters.

    A match starts where the text before it ends: ``split`` gives the texts between matches, so positions are running
    sums. Texts without a match aren't split; ``possible`` is a cheap condition that every text with a match fulfils.
    """
    found = F.regexp_extract_all(text, F.lit(pattern if group else f"({pattern})"), F.lit(0 if group else 1))
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"))
    if group:
        parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"),
                             F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {SPAN})").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["hit"])
        one = F.array(F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end")))
        passes = F.length(m["part"] if group else m["hit"]) >= least
        return F.struct(end.cast("long").alias("at"), F.when(passes, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    return F.when(possible & text.rlike(pattern), F.aggregate(parts, zero, step)["spans"]).otherwise(F.expr(f"cast(array() as {SPAN})"))


def base_spans(text: Column, long_run: Column) -> Column:
    """Base spans by start, then kind. ``long_run``: whether CANDIDATE is in the text, as it is where HEX passes."""
    # runs of fewer characters fail, and a run is matched whole, so the least length can stand in the pattern
    access = _matches(text, F.contains(text, F.lit("AKIA")), r"AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4), 1)
    hexes = _matches(text, long_run, r"[0-9a-f]{%d,}" % LEAST_HEX, 2)
    return F.array_sort(F.concat(_matches(text, F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), ASSIGN, 0, LEAST_ASSIGN, 2), access, hexes))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution, within a hundredth of its value."""

    def upper(z: Column) -> Column:
        a = F.abs(z)
        q = F.exp(-a * a / 2) / (a * 1.64 + F.sqrt(a * a * 0.76 + 4.0))
        return F.when(z >= 0, q).otherwise(1.0 - q)

    return _let(z, upper)


def _chi_tail(chi: Column, df: Column) -> Column:
    """Upper tail of chi-squared by Wilson and Hilferty's cube root."""
    s = F.lit(2.0) / (df * 9)
    return _tail((F.pow(chi / df, F.lit(1 / 3)) - (F.lit(1.0) - s)) / F.sqrt(s))


def _count(s: Column, chars: str) -> Column:
    """Characters of s that are among ``chars`` (a bracket expression's inside)."""
    return F.length(s) - F.length(F.regexp_replace(s, f"[{chars}]", ""))


def _runs(runs: Column, ones: Column, n: Column) -> Column:
    """Two-sided p-value of the number of runs in n symbols of two kinds, ``ones`` of them of one kind (with a correction for continuity)."""

    def two_sided(mean: Column) -> Column:
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        return F.least(_tail(F.greatest(F.abs(runs - mean) - 0.5, F.lit(0.0)) / spread) * 2, F.lit(1.0))

    return F.when((ones == 0) | (ones == n), 1.0).otherwise(_let(ones * (n - ones) * 2 / n + 1, two_sided))


def _by_kind(kind: Column, values: list) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), kind + 1)


def misfit(token: Column) -> Column:
    """log10 of the combined p-value of the battery for one token; null if it has no known encoding."""

    def inferred(s: Column) -> Column:
        kind = F.coalesce(*(F.when(s.rlike(symbols), F.lit(k)) for k, (_, symbols, _) in enumerate(ENCODINGS)))
        return F.struct(s.alias("s"), kind.alias("kind"))

    def known(x: Column) -> Column:
        # - and _ are the last two in the form for addresses, and alphabets of one case are in small letters
        plain = F.when(x["kind"] < 3, F.lower(x["s"])).otherwise(F.translate(x["s"], "-_", "+/"))
        return F.struct(plain.alias("plain"), x["kind"].alias("kind"), F.length(x["s"]).cast("double").alias("n"), _by_kind(x["kind"], [a for _, _, a in ENCODINGS]).alias("alphabet"))

    tested = lambda x: F.when(x["kind"].isNotNull(), _let(_let(known(x), _statistics), _battery))
    return _let(_let(F.regexp_replace(token, "=+$", ""), inferred), tested)


def _statistics(x: Column) -> Column:
    """What the tests need: counts of symbols and of their classes, and one walk over the symbols' places in the alphabet."""
    plain, kind, n, alphabet = x["plain"], x["kind"], x["n"], x["alphabet"]
    size = F.length(alphabet).cast("double")
    squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda a, c: a + F.pow((F.length(plain) - F.length(F.replace(plain, c))).cast("double"), F.lit(2.0)))
    middle = (size - 1) / 2
    zero = F.struct(F.lit(None).cast("double").alias("last"), *(F.lit(0.0).alias(k) for k in ("up", "runs", "lag", "sq")))

    def step(a: Column, c: Column) -> Column:
        def add(v: Column) -> Column:
            first, d, d0 = a["last"].isNull(), v - middle, a["last"] - middle
            turn = F.when(first | ((v > middle) != (a["last"] > middle)), 1.0).otherwise(0.0)
            return F.struct(v.alias("last"), (a["up"] + F.when(v > middle, 1.0).otherwise(0.0)).alias("up"), (a["runs"] + turn).alias("runs"),
                            (a["lag"] + F.when(first, 0.0).otherwise(d * d0)).alias("lag"), (a["sq"] + d * d).alias("sq"))

        return _let((F.instr(alphabet, c) - 1).cast("double"), add)

    parts = _count(F.regexp_replace(plain, "[0-9]++", "0"), "0") + _count(F.regexp_replace(plain, "[^0-9]++", "a"), "a")
    count = {"digits": "0-9", "capitals": "A-Z", "small": "a-z", "others": "+/", "rare": RARE + RARE.upper()}
    return F.struct(kind.alias("kind"), n.alias("n"), size.alias("size"), squares.alias("squares"), F.aggregate(F.split(plain, ""), zero, step).alias("walk"),
                    parts.cast("double").alias("parts"), *(_count(plain, chars).cast("double").alias(k) for k, chars in count.items()))


def _battery(x: Column) -> Column:
    kind, n, walk = x["kind"], x["n"], x["walk"]
    symbols = _chi_tail(x["squares"] * x["size"] / n - n, x["size"] - 1)
    classes = []
    for name, held in (("digits", str.isdigit), ("capitals", str.isupper), ("small", str.islower), ("others", lambda c: c in "+/")):
        want = _by_kind(kind, [sum(map(held, a)) / len(a) for _, _, a in ENCODINGS]) * n
        classes.append(F.when(want > 0, F.pow(x[name] - want, F.lit(2.0)) / want).otherwise(0.0))
    # the rare among the letters are one more degree of freedom
    letters = x["capitals"] + x["small"]
    share, worded = len(RARE) / 26, (kind > 0) & (letters > 0)
    rare = F.when(worded, F.pow(x["rare"] - letters * share, F.lit(2.0)) / (letters * share * (1 - share))).otherwise(0.0)
    by_class = _chi_tail(sum(classes[1:], classes[0]) + rare, _by_kind(kind, [1.0, 1.0, 1.0, 2.0, 3.0]) + F.when(worded, 1.0).otherwise(0.0))
    # with symbols on one side of the middle only, the chance of that
    runs = F.when((walk["up"] == 0) | (walk["up"] == n), F.pow(F.lit(2.0), 1 - n)).otherwise(_runs(walk["runs"], walk["up"], n))
    serial = _tail(F.abs(walk["lag"] / F.greatest(walk["sq"], F.lit(1e-9))) * F.sqrt(n)) * 2
    least = F.least(symbols, by_class, runs, _runs(x["parts"], x["digits"], n), serial)
    return F.log10(F.least(F.greatest(least * 5, F.lit(1e-30)), F.lit(1.0)))


def _band(start: Column, end: Column) -> Column:
    return F.least(F.floor((end - start) / BAND), F.lit(BANDS)).cast("int")


def _bin(log_p: Column) -> Column:
    return F.least(F.floor(-log_p * PER_DECADE), F.lit(BINS)).cast("int")


def judged(text: Column, base: Column) -> Column:
    """The candidates that no base span touches, with the band of their length and the bin of their p-value."""
    found = _matches(text, F.lit(True), CANDIDATE, 3)
    free = F.filter(found, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    scored = F.transform(free, lambda c: F.struct(c.alias("span"), _band(c["start"], c["end"]).alias("band"),
                                                  _bin(misfit(F.substring(text, c["start"].cast("int") + 1, (c["end"] - c["start"]).cast("int")))).alias("bin")))
    return F.filter(scored, lambda c: c["bin"].isNotNull())


def rejection_bins(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> dict[int, int]:
    """For each length band the least bin of p that Benjamini and Hochberg's step rejects as not random.

    From counts per (band, bin), at most (BANDS + 1) * (BINS + 1) rows; p-values count as the upper end of their bin.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = docs.select(text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    d = d.withColumn("base", base_spans(F.col("text"), F.lit(True))).select(F.explode(judged(F.col("text"), F.col("base"))).alias("c"))
    rows = d.groupBy("c.band", "c.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    least: dict[int, int] = {}
    for band in {r["band"] for r in rows}:
        counts = {r["bin"]: r["n"] for r in rows if r["band"] == band}
        total, seen = sum(counts.values()), 0
        for k in sorted(counts, reverse=True):
            seen += counts[k]
            if 10 ** (-k / PER_DECADE) <= rate * seen / total:
                least[band] = k
    return least


def all_spans(text: Column, base: Column, rejected: dict[int, int]) -> Column:
    """Base spans and random ones, by start, then kind."""
    limits = F.array(*(F.lit(min(rejected.get(k, BINS + 1), BINS + 1)) for k in range(BANDS + 1)))
    random = F.filter(judged(text, base), lambda c: c["bin"] < F.element_at(limits, c["band"] + 1))
    return F.array_sort(F.concat(base, F.transform(random, lambda c: c["span"])))


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each row.

    Positions count code points, ends are exclusive. Null and empty texts have no spans: the digest of the empty string and "".
    """
    rejected = rejection_bins(docs, text_col, rate)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("run", F.col("text").rlike(CANDIDATE)).withColumn("base", base_spans(F.col("text"), F.col("run")))
    d = d.withColumn("all", F.when(F.col("run"), all_spans(F.col("text"), F.col("base"), rejected)).otherwise(F.col("base")))
    kinds = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return d.select("doc_id", *kinds, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("all")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", rate: float = RATE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span (overlapping ones joined) replaced by ``mark``; all other columns and null texts unchanged."""
    rejected = rejection_bins(docs, text_col, rate)
    column = F.col(f"`{text_col}`")
    names = docs.columns
    run, base, spans, clean = (fresh(f"secret_{k}", names) for k in ("run", "base", "spans", "clean"))
    d = docs.withColumn(run, F.coalesce(column.rlike(CANDIDATE), F.lit(False)))
    d = d.withColumn(base, base_spans(F.coalesce(column, F.lit("")), F.col(run)))
    d = d.withColumn(spans, F.when(F.col(run), all_spans(column, F.col(base), rejected)).otherwise(F.col(base)))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(column, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int"))
        apart = (s["start"] > a["at"]) | (a["at"] == 0)
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(apart, F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"]).alias("out"))

    done = lambda a: F.concat(a["out"], F.substring(column, a["at"].cast("int") + 1, 2**31 - 1))
    d = d.withColumn(clean, F.when(F.size(spans) > 0, F.aggregate(F.col(spans), zero, step, done)).otherwise(column))
    return d.select(*(F.col(clean).alias(c) if c == text_col else F.col(f"`{c}`") for c in names))

