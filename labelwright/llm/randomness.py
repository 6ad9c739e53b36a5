"""Secret scan: fixed patterns, and a battery of randomness tests under a discovery rate.

Everything is a column expression. Positions come from the lengths of the pieces between
matches, so they count code points; they are added up in groups of pieces, so that the cost of
a document grows with its matches. A candidate is every run of 16 or more letters, digits and
base-64 signs. Its encoding is inferred from its characters, and three tests ask whether it is a
random string over that alphabet: a chi-squared statistic of symbol counts, a runs test of the
upper and lower half of the alphabet, and the serial correlation of neighbours. Fisher's method
joins them to one probability.

How often ordinary text looks that random is measured on decoys. Candidates with letters and
digits have up to three neighbouring words of eight or more plain letters, joined to 16 or more
and judged over letters and digits; candidates of letters alone have the same words judged over
their own letters; candidates without a letter have neighbouring numbers, joined. Per such class
and length class the lowest cut is taken at which decoys would make at most ``rate`` of what
passes; a length class with few decoys also counts those of shorter ones, which look random more
easily. Counts per class and cut cover all documents; their table has a fixed size, whatever the
input. Texts are scanned once: candidates and decoys are written with their results.

Defined results: null is the empty text; equal rows are scanned each on their own; a class
without decoys accepts no candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.sources.scratch import store

# Fixed patterns of the three known kinds; group 2 of the first is the value.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

MIN_LENGTH = 16
RATE = 0.05
ENOUGH_DECOYS = 200
LENGTH_CLASSES = (16, 18, 20, 24, 28, 32, 40, 48, 64, 96)
CUTS = (0.0001, 0.0003, 0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)

_SET = "A-Za-z0-9+/_-"
_RUN = rf"[{_SET}]{{{MIN_LENGTH},}}+={{0,2}}"
_CANDIDATE = rf"(?<![{_SET}]){_RUN}"
_DECOY = rf"(?<![{_SET}])[A-Za-z]{{8,}}+(?:\x20[A-Za-z]{{8,}}+){{0,2}}+(?![={_SET}])"
_NUMBERS = rf"(?<![{_SET}])[0-9]{{4,}}+(?:\x20[0-9]{{4,}}+){{1,3}}+(?![={_SET}])"
MIXED, LETTERS, NO_LETTERS = range(3)
GROUP = 256

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest alphabet to the widest: pattern, symbols in order.
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
)
_WIDEST = _UPPER + _LOWER + _DIGITS + "+/-_"


def pieces(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, match) in code points."""
    around = F.lit(rf"(?s)(.*?)({pattern}|\z)")
    pairs = F.arrays_zip(F.regexp_extract_all(text, around, F.lit(1)).alias("g"), F.regexp_extract_all(text, around, F.lit(2)).alias("m"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + F.char_length(pair["g"])
        end = start + F.char_length(pair["m"])
        found = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("match"))
        return F.struct(end.alias("at"), F.when(F.length(pair["m"]) > 0, F.concat(done["out"], F.array(found))).otherwise(done["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def grouped(all_pairs: Column) -> Column:
        """Each group from place 0 on."""
        last = F.floor((F.size(all_pairs) - 1) / GROUP).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda g: F.aggregate(F.slice(all_pairs, g * GROUP + 1, F.lit(GROUP)), zero, add))

    def moved(groups: Column) -> Column:
        """The groups one behind the other."""
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            groups,
            first,
            lambda a, g: F.struct((a["at"] + g["at"]).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts")),
            lambda a: a["starts"],
        )
        shift = lambda s, by: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match"))
        return F.flatten(F.zip_with(groups, starts, lambda g, by: F.transform(g["out"], lambda s: shift(s, by))))

    return F.when(F.regexp_like(text, F.lit(pattern)), _each(_each(pairs, grouped), moved)).otherwise(empty)


def _kept(found: Column, kind: int, test) -> Column:
    return F.transform(F.filter(found, test), lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _assign_value(match: Column) -> Column:
    return F.regexp_extract(match, "^" + ASSIGN, 2)


def base_spans(text: Column) -> Column:
    """(start, kind, end) of the fixed kinds, in order."""
    return F.array_sort(
        F.concat(
            _kept(pieces(text, ASSIGN), 0, lambda x: F.char_length(_assign_value(x["match"])) >= 12),
            # A run that is long enough is the same whether shorter ones are matched or not.
            _kept(pieces(text, ACCESS), 1, lambda x: x["end"] - x["start"] >= 18),
            _kept(pieces(text, r"(?<![0-9a-f])[0-9a-f]{16,}+"), 2, lambda x: x["end"] - x["start"] >= 16),
        )
    )


def _upper_tail(z: Column) -> Column:
    """Probability of a standard normal value above z, by a logistic approximation."""
    t = 1.5976 * z + 0.07056 * z * z * z
    return F.greatest(1 / (1 + F.exp(F.least(F.greatest(t, F.lit(-500.0)), F.lit(500.0)))), F.lit(1e-12))


def randomness(token: Column) -> Column:
    """Probability that a random string over the inferred alphabet looks less random."""
    body = F.regexp_replace(token, "=+$", "")
    alphabet = F.lit(_WIDEST)
    for pattern, symbols in reversed(ENCODINGS):
        alphabet = F.when(F.regexp_like(token, F.lit(pattern)), F.lit(symbols)).otherwise(alphabet)
    return _each(F.struct(alphabet.alias("a"), body.alias("body")), _coded)


def _coded(s: Column) -> Column:
    codes = F.transform(F.split(s["body"], ""), lambda c: F.instr(s["a"], c).cast("double"))
    length = lambda t: F.char_length(t).cast("double")
    return _each(F.struct(codes.alias("x"), length(s["a"]).alias("k"), length(s["body"]).alias("n")), _battery)


def _battery(s: Column) -> Column:
    x, k, n = s["x"], s["k"], s["n"]
    zero = F.lit(0.0)
    squares = F.aggregate(F.array_distinct(x), zero, lambda a, c: a + F.pow(F.size(F.filter(x, lambda y: y == c)).cast("double"), F.lit(2.0)))
    chi = k / n * squares - n
    z_uniform = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    # One walk gives the sums of neighbours and the number of half changes.
    first = F.struct(
        zero.alias("sum"), zero.alias("sq"), zero.alias("cross"), zero.alias("high"), F.lit(1.0).alias("runs"), F.element_at(x, 1).alias("last")
    )

    def walk(a: Column, v: Column) -> Column:
        half = k / 2
        return F.struct(
            (a["sum"] + v).alias("sum"),
            (a["sq"] + v * v).alias("sq"),
            (a["cross"] + a["last"] * v).alias("cross"),
            (a["high"] + F.when(v > half, 1.0).otherwise(0.0)).alias("high"),
            (a["runs"] + F.when((v > half) != (a["last"] > half), 1.0).otherwise(0.0)).alias("runs"),
            v.alias("last"),
        )

    w = F.aggregate(x, first, walk)
    sums = F.struct(w.alias("w"), z_uniform.alias("z"), F.element_at(x, 1).alias("head"), F.element_at(x, -1).alias("tail"))
    return _each(sums, lambda s: _joined(s["w"], s["head"], s["tail"], k, n, s["z"]))


def _each(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _joined(w: Column, head: Column, tail: Column, k: Column, n: Column, z_uniform: Column) -> Column:
    mean = w["sum"] / n
    spread = w["sq"] - n * mean * mean
    # The walk multiplies the first value with itself; neighbours start at the second.
    cross = w["cross"] - head * head - mean * (2 * w["sum"] - head - tail) + (n - 1) * mean * mean
    r = F.when(spread > 1e-9, cross / F.greatest(spread, F.lit(1e-9))).otherwise(F.lit(1.0))
    a, b = w["high"], n - w["high"]
    product = 2 * a * b
    var = F.greatest(product * (product - n) / (n * n * (n - 1)), F.lit(1e-9))
    z_runs = F.when((a > 0) & (b > 0), (w["runs"] - (product / n + 1)) / F.sqrt(var)).otherwise(F.lit(30.0))
    scores = F.array(z_uniform, F.abs(z_runs), F.abs((r + 1 / n) * F.sqrt(n)))
    tails = F.transform(F.transform(scores, _upper_tail), lambda p, i: F.when(i == 0, p).otherwise(F.least(2 * p, F.lit(1.0))))
    half = F.aggregate(tails, F.lit(0.0), lambda total, p: total - F.ln(p))
    # The upper tail of chi-squared with six degrees of freedom.
    return _each(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def _length_class(n: Column) -> Column:
    return sum((F.when(n >= x, 1).otherwise(0) for x in LENGTH_CLASSES[1:]), F.lit(0))


def _cut_class(p: Column) -> Column:
    """How many of the cuts the probability reaches."""
    return sum((F.when(p >= c, 1).otherwise(0) for c in CUTS), F.lit(0))


def _kind(token: Column) -> Column:
    """Whether a token has letters and digits, letters alone, or no letters."""
    letters, digits = F.regexp_like(token, F.lit("[A-Za-z]")), F.regexp_like(token, F.lit("[0-9]"))
    return F.when(~letters, NO_LETTERS).when(digits, MIXED).otherwise(LETTERS)


def _extracted(text: Column, pattern: str) -> Column:
    found = F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    joined = F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda t: F.replace(t, F.lit(" "), F.lit("")))
    return F.filter(joined, lambda t: F.char_length(t) >= MIN_LENGTH)


def _judged(token: Column, kind: Column, judged: Column) -> Column:
    # Inside a lambda nothing is shared, so the classes get values that are computed once.
    size, cut = _each(F.char_length(token), _length_class), _each(randomness(judged), _cut_class)
    return F.struct(kind.cast("int").alias("kind"), size.alias("size"), cut.alias("cut"))


def candidates(text: Column) -> Column:
    """(start, end, kind, size, cut) of every run, judged."""
    token = lambda x: _judged(x["match"], _kind(x["match"]), x["match"])
    each = lambda x: _each(token(x), lambda j: F.struct(x["start"].alias("start"), x["end"].alias("end"), *[j[c].alias(c) for c in ("kind", "size", "cut")]))
    return F.transform(pieces(text, _CANDIDATE), each)


def decoys(text: Column) -> Column:
    """(kind, size, cut) of the decoys of each class."""
    words = _extracted(text, _DECOY)
    # A digit behind the letters makes them be judged as letters and digits, as candidates are.
    as_mixed = F.transform(words, lambda t: _judged(t, F.lit(MIXED), F.concat(t, F.lit("0"))))
    as_letters = F.transform(words, lambda t: _judged(t, F.lit(LETTERS), t))
    numbers = F.transform(_extracted(text, _NUMBERS), lambda t: _judged(t, F.lit(NO_LETTERS), t))
    return F.concat(as_mixed, as_letters, numbers)


def scanned(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Written once: doc_id, base spans, judged candidates and decoys."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_t"))
    columns = [base_spans(F.col("_t")).alias("_base"), candidates(F.col("_t")).alias("_found"), decoys(F.col("_t")).alias("_decoys")]
    return store(rows.select("doc_id", *columns, *(["_t"] if keep_text else [])), "secrets")


def thresholds(rows: DataFrame, rate: float = RATE) -> dict[tuple[int, int], int]:
    """(class, length class) to the number of cuts that an accepted candidate reaches at least."""
    one = lambda column, decoy: rows.select(F.explode(column).alias("x")).select(F.lit(decoy).alias("decoy"), "x.kind", "x.size", "x.cut")
    both = one("_found", False).unionByName(one("_decoys", True))
    counts = {tuple(r)[:4]: r[4] for r in both.groupBy("decoy", "kind", "size", "cut").count().collect()}
    found = {}
    for kind in range(3):
        for size in range(len(LENGTH_CLASSES)):
            first = size
            decoys_from = lambda first: sum(n for (d, k, s, _), n in counts.items() if d and k == kind and first <= s <= size)
            while first and decoys_from(first) < ENOUGH_DECOYS:
                first -= 1
            n_decoys = decoys_from(first)
            targets = sum(n for (d, k, s, _), n in counts.items() if not d and k == kind and s == size)
            for i in range(1, len(CUTS) + 1):
                passed = sum(n for (d, k, s, c), n in counts.items() if not d and k == kind and s == size and c >= i)
                wrong = sum(n for (d, k, s, c), n in counts.items() if d and k == kind and first <= s <= size and c >= i)
                if n_decoys and passed and (wrong + 1) / (n_decoys + 1) * targets <= rate * passed:
                    found[kind, size] = i
                    break
    return found


def random_spans(found: Column, accepted: dict[tuple[int, int], int]) -> Column:
    """(start, kind, end) of judged candidates that pass the cut of their class."""
    if not accepted:
        return F.array().cast("array<struct<start:int,kind:int,end:int>>")
    cuts = F.create_map([F.lit(v) for (kind, size), cut in accepted.items() for v in (kind * 100 + size, cut)])
    return _kept(found, 3, lambda x: F.coalesce(x["cut"] >= F.try_element_at(cuts, x["kind"] * 100 + x["size"]), F.lit(False)))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document: counts and hash of the fixed kinds, and all spans."""
    held = scanned(docs)
    rows = held.select("doc_id", "_base", random_spans(F.col("_found"), thresholds(held, rate)).alias("_more"))
    outside = F.filter("_more", lambda m: ~F.exists("_base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("_base", outside))).alias("spans"),
        F.size(outside).cast("long").alias("n_random"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """doc_id and text with every span replaced."""
    held = scanned(docs, keep_text=True)
    spans = F.concat("_base", random_spans(F.col("_found"), thresholds(held, rate)))
    rows = held.select("doc_id", "_t", F.array_sort(spans).alias("_s"))
    whole = F.col("_t")

    def add(done: Column, s: Column) -> Column:
        start = F.greatest(s["start"], done["at"])
        inside = s["end"] <= done["at"]
        gap = F.substring(whole, done["at"] + 1, start - done["at"])
        more = F.when(inside, done["out"]).when(s["start"] < done["at"], done["out"]).otherwise(F.concat(done["out"], gap, F.lit(mark)))
        return F.struct(F.greatest(s["end"], done["at"]).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    built = F.aggregate("_s", start, add, lambda d: F.concat(d["out"], F.substring(whole, d["at"] + 1, F.char_length(whole))))
    return rows.select("doc_id", built.alias("text"))
