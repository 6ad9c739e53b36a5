"""Near-equal lines: a segment-partition edit join, in DataFrame functions only.

A line is cut into ``edits`` + 1 segments. If another line is within ``edits`` edits, one of its
segments stands unchanged in it, at a place that the lengths allow. So every line is indexed by
its segments under its length, and probes the indexes of its own and slightly smaller lengths
with the substrings at the allowed places. Pairs that meet are verified by a banded
bit-parallel edit distance: one number holds the vertical differences inside the band, and a
step per character moves the band down.

Keys are counted first, and only lines that meet a different one are carried on; equal lines
are one line with its first place. A segment that very many different lines share
(``HOT`` or more) is not joined line by line: its lines are packed into blocks of bounded size,
a probe meets a block as one row. Before a distance is computed, the counts of some characters
must not differ by more than edits can change them. Lines are classed by the connected components of their links.

Documents are addressed by id and two hashes of their text; rows equal in both are one
document. Defined results: null is the empty text; lines are compared without outer blanks;
lines of fewer than ``min_chars`` characters, by default the fewest that the method can hold against
one another, take no part and are never removed, unless ``shorter`` is asked for: then they are
held for equality, as two edits turn a short line into any other. The first place of a class, by
document id and then by place, is the one that stays. Blank lines always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.llm.components import components
from labelwright.llm.rows import BROADCAST_BYTES, packed
from labelwright.sources.scratch import store

EDITS = 2
#: Below, a segment and the places where it may stand would overlap those of the next.
MIN_CHARS = (EDITS + 1) ** 2
HOT = 16
COUNTED = "etaoinshrdlucmfwgypbvkz ,."


def _each(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance if it is at most edits, else null, by banded bit vectors.

    Bit i of the band stands for row (column - edits + i). Going one column right, the band
    moves one row down, so the differences of the column before are shifted by one.
    """
    width = 2 * edits + 1
    if width > 60:
        raise ValueError("at most 29 edits")
    mask, top = (1 << width) - 1, 1 << (width - 1)
    state = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"), F.char_length(a).alias("n"), F.char_length(b).alias("m"))

    def run(s: Column) -> Column:
        def column(d: Column, j: Column) -> Column:
            # The distance is at least the band's lowest row less its width.
            return F.when(d["low"] > edits + width, d).otherwise(step(d, j))

        def step(d: Column, j: Column) -> Column:
            # Rows of the band that hold the character of this column.
            equal = F.aggregate(
                F.sequence(F.lit(0), F.lit(width - 1)),
                F.lit(0).cast("long"),
                lambda bits, i: F.when(
                    (j - edits + i >= 1) & (j - edits + i <= s["n"]) & (F.try_element_at(s["a"], F.greatest(j - edits + i, F.lit(1))) == F.element_at(s["b"], j)),
                    bits.bitwiseOR(_bit(i)),
                ).otherwise(bits),
            )
            vp, vn = d["vp"], d["vn"]
            return _each(
                equal,
                lambda eq: _each(
                    ((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(mask)),
                    lambda d0: _each(
                        F.struct(
                            vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(F.lit(mask)).alias("hp"),
                            d0.bitwiseAND(vp).alias("hn"),
                            F.shiftright(d0, 1).alias("x"),
                        ),
                        lambda h: F.struct(
                            h["hn"].bitwiseOR(F.bitwise_not(h["x"].bitwiseOR(h["hp"]))).bitwiseAND(F.lit(mask)).alias("vp"),
                            h["x"].bitwiseAND(h["hp"]).alias("vn"),
                            # The lowest row of the band goes along the diagonal: one more edit without a match.
                            (
                                d["low"] + F.when(j + edits <= s["n"], F.when(d0.bitwiseAND(F.lit(top)) != 0, 0).otherwise(1)).otherwise(_below(h, j, s["n"], edits))
                            ).alias("low"),
                        ),
                    ),
                ),
            )

        # Rows above the first have no bits; those of column 0 from the first on go up by one each.
        ups = F.aggregate(F.sequence(F.lit(0), F.lit(width - 1)), F.lit(0).cast("long"), lambda v, i: F.when(i >= edits, v.bitwiseOR(_bit(i))).otherwise(v))
        start = F.struct(ups.alias("vp"), F.lit(0).cast("long").alias("vn"), F.least(F.lit(edits), s["n"]).alias("low"))
        end = F.aggregate(F.sequence(F.lit(1), s["m"]), start, column)
        far = F.abs(s["n"] - s["m"]) > edits
        return F.when(far, F.lit(None).cast("int")).when(s["m"] == 0, s["n"]).when(s["n"] == 0, s["m"]).otherwise(F.when(end["low"] <= edits, end["low"]))

    return _each(state, run)


def _below(h: Column, j: Column, n: Column, edits: int) -> Column:
    """Change of the last row from the column before, once the band reaches it."""
    bit = n - j + edits
    one = _bit(F.greatest(F.least(bit, F.lit(2 * edits)), F.lit(0)))
    return F.when(h["hp"].bitwiseAND(one) != 0, 1).when(h["hn"].bitwiseAND(one) != 0, -1).otherwise(0)


def _segment(length: Column, part: int, edits: int) -> tuple[Column, Column]:
    """Start and size of a segment (from 1); the later ones are longer by one where sizes differ."""
    size = F.floor(length / (edits + 1)).cast("int")
    longer = length % (edits + 1)
    before = F.greatest(F.lit(part - 1 - (edits + 1)) + longer, F.lit(0))
    return size * (part - 1) + before, size + F.when(longer >= edits + 2 - part, 1).otherwise(0)


def segment_keys(wide: Column, n: Column, edits: int) -> Column:
    """Array of (key, index): hashes of the substrings that may be a segment of a line that is
    not longer, and whether the substring is a segment of this line under its own length.

    ``wide`` is the line in four bytes a character, where cutting takes no counting, and ``n``
    its characters. A segment can only stand where the segments before and after it leave room
    for all edits.
    """
    keys = []
    for less in range(edits + 1):
        for part in range(1, edits + 2):
            start, size = _segment(n - less, part, edits)
            left, right = part - 1, edits + 1 - part
            for shift in range(max(-left, less - right), min(left, less + right) + 1):
                key = F.xxhash64(n - less, F.lit(part), F.substring(wide, 4 * (start + shift) + 1, 4 * size))
                keys.append(F.struct(key.alias("key"), F.lit(less == 0 and shift == 0).alias("index")))
    return F.array(*keys)


def character_counts(text: Column) -> Column:
    """How often some characters stand in a line."""
    whole = F.octet_length(text)
    return F.array(*[whole - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in COUNTED])


def may_be_near(a: Column, b: Column, edits: int) -> Column:
    """An edit moves at most two counts by one each."""
    return sum((F.abs(a[i] - b[i]) for i in range(len(COUNTED))), F.lit(0)) <= 2 * edits


def _with_keys(docs: DataFrame) -> DataFrame:
    """The rows as _row, and their two keys."""
    text = F.coalesce("_row.text", F.lit(""))
    return packed(docs).withColumns({"_k1": F.xxhash64("_row.doc_id", text), "_k2": F.xxhash64(text, "_row.doc_id", F.lit(71))})


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, _k1, _k2, _pos, _line, _h1, _h2) of every line that is long enough."""
    keyed = _with_keys(docs.select("doc_id", "text"))
    lines = keyed.select("_row.doc_id", "_k1", "_k2", F.posexplode(F.split(F.coalesce("_row.text", F.lit("")), "\n")).alias("_pos", "_raw"))
    return (
        lines.select("doc_id", "_k1", "_k2", "_pos", F.trim("_raw").alias("_line"))
        .where(F.char_length("_line") >= min_chars)
        .withColumns({"_h1": F.xxhash64("_line"), "_h2": F.xxhash64("_line", F.lit(29))})
    )


def _place() -> Column:
    """First places compare by document id, missing ids last, then by text and line."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("_pos").alias("pos"))


def _meetings(lines: DataFrame, edits: int) -> tuple[DataFrame, DataFrame]:
    """(_key, _index, _h1, _h2) at keys where different lines meet, and those lines.

    Keys are counted first, with nothing but hashes in the shuffle. If the keys with two
    different lines are counted to fit, they are broadcast and the lines come along in the
    same scan; else hashes are joined and the lines fetched by theirs.
    """
    # Columns of their own, so that what the keys share is computed once.
    wide = lines.select("_h1", "_h2", "_line", F.encode("_line", "UTF-32").alias("_wide"))
    sized = wide.withColumn("_n", F.floor(F.octet_length("_wide") / 4).cast("int"))
    keyed = sized.select("_h1", "_h2", "_line", segment_keys(F.col("_wide"), F.col("_n"), edits).alias("_keys"))
    # The outer form: for the inner one, the optimizer computes the array once more in a filter.
    each = keyed.select("_h1", "_h2", "_line", F.explode_outer("_keys").alias("x"))
    each = each.select(F.col("x.key").alias("_key"), F.col("x.index").alias("_index"), "_h1", "_h2", "_line")
    ends = each.groupBy(F.col("_key").alias("_shared")).agg(F.min("_h1").alias("_low"), F.max("_h1").alias("_high"), F.max("_index").alias("_any"))
    shared = store(ends.where("_low != _high and _any").select("_shared"), "shared")
    if shared.count() * 16 <= BROADCAST_BYTES:
        met = store(each.join(F.broadcast(shared), F.col("_key") == F.col("_shared")).drop("_shared"), "met")
        return met.drop("_line"), met.dropDuplicates(["_h1", "_h2"]).select("_h1", "_h2", "_line")
    met = store(each.drop("_line").join(shared, F.col("_key") == F.col("_shared")).drop("_shared"), "met")
    who = met.select(F.col("_h1").alias("_w1"), F.col("_h2").alias("_w2")).distinct()
    texts = lines.select("_h1", "_h2", "_line").join(who, (F.col("_h1") == F.col("_w1")) & (F.col("_h2") == F.col("_w2")), "left_semi")
    return met, texts.dropDuplicates(["_h1", "_h2"])


def line_links(lines: DataFrame, edits: int = EDITS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Lines that met others (_id, _h1, _h2, _line), and (u, v, distance) of those within edits."""
    met, some = _meetings(lines, edits)
    some = some.withColumns({"_chars": character_counts(F.col("_line")), "_id": F.monotonically_increasing_id()})
    some = store(some, "some")
    ids = some.select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), "_id")
    members = met.join(ids, (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2"))).select("_key", "_index", "_id").distinct()
    members = store(members, "members")
    index = members.where("_index").select("_key", "_id")
    probes = members.select(F.col("_key").alias("_probe"), F.col("_id").alias("_by")).distinct()
    sizes = index.groupBy(F.col("_key").alias("_hot")).agg(F.count(F.lit(1)).alias("_size"))
    busy = store(sizes.where(F.col("_size") >= hot), "busy")
    cold = index.join(busy, F.col("_key") == F.col("_hot"), "left_anti")
    together = cold.join(probes, (F.col("_key") == F.col("_probe")) & (F.col("_id") != F.col("_by")))
    pairs = together.select(F.greatest("_id", "_by").alias("u"), F.least("_id", "_by").alias("v")).distinct()
    left = some.select(F.col("_id").alias("u"), F.col("_line").alias("_a"), F.col("_chars").alias("_ca"))
    right = some.select(F.col("_id").alias("v"), F.col("_line").alias("_b"), F.col("_chars").alias("_cb"))
    both = pairs.join(left, "u").join(right, "v")
    near = both.where(may_be_near(F.col("_ca"), F.col("_cb"), edits)).select("u", "v", "_a", "_b")
    return some, _decided(near.unionByName(_hot_pairs(some, index, probes, busy, edits, hot)), edits)


def _hot_pairs(lines: DataFrame, index: DataFrame, probes: DataFrame, busy: DataFrame, edits: int, hot: int) -> DataFrame:
    """Pairs of lines that meet at a busy key and whose character counts allow it."""
    text = lines.select(F.col("_id").alias("_i"), "_line", "_chars")
    members = index.join(busy, F.col("_key") == F.col("_hot")).join(text, F.col("_id") == F.col("_i"))
    block = F.pmod(F.xxhash64("_id"), F.ceil(F.col("_size") / (4 * hot)).cast("long"))
    blocks = members.groupBy("_key", block.alias("_block")).agg(F.collect_list(F.struct("_id", "_line", "_chars")).alias("_many"))
    own = text.select("_i", F.col("_line").alias("_own"), F.col("_chars").alias("_own_chars"))
    asking = probes.join(busy, F.col("_probe") == F.col("_hot"), "left_semi").join(own, F.col("_by") == F.col("_i"))
    met = blocks.join(asking.select("_by", "_probe", "_own", "_own_chars"), F.col("_key") == F.col("_probe"))
    close = F.filter("_many", lambda x: (x["_id"] != F.col("_by")) & may_be_near(x["_chars"], F.col("_own_chars"), edits))
    some = met.select("_by", "_own", close.alias("_close")).where(F.size("_close") > 0)
    each = some.select("_by", "_own", F.explode("_close").alias("x")).select("_by", "_own", F.col("x._id").alias("_id"), F.col("x._line").alias("_line"))
    up = F.col("_id") > F.col("_by")
    return each.select(
        F.greatest("_id", "_by").alias("u"),
        F.least("_id", "_by").alias("v"),
        F.when(up, F.col("_line")).otherwise(F.col("_own")).alias("_a"),
        F.when(up, F.col("_own")).otherwise(F.col("_line")).alias("_b"),
    ).dropDuplicates(["u", "v"])


def _decided(pairs: DataFrame, edits: int) -> DataFrame:
    judged = pairs.select("u", "v", edit_distance(F.col("_a"), F.col("_b"), edits).alias("distance"))
    return judged.where("distance is not null").groupBy("u", "v").agg(F.min("distance").alias("distance"))


def _removals(docs: DataFrame, edits: int, min_chars: int, hot: int, shorter: bool) -> DataFrame:
    """Per document key: links of its lines, places to remove, class names."""
    if min_chars < (edits + 1) ** 2:
        raise ValueError(f"{edits} edits need lines of at least {(edits + 1) ** 2} characters")
    lines = _lines(docs, 1 if shorter else min_chars)
    places = store(lines.drop("_line"), "places")
    some, links = line_links(lines.where(F.char_length("_line") >= min_chars), edits, hot)
    links = store(links, "links")
    both = links.select(F.col("u").alias("_l")).unionAll(links.select(F.col("v").alias("_l")))
    counts = both.groupBy("_l").agg(F.count(F.lit(1)).alias("_n_links"))
    linked = components(links).join(counts, F.col("node") == F.col("_l")).join(some, F.col("node") == F.col("_id"))
    linked = linked.select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), "root", "_n_links")
    # Lines in two places, or linked; the others are the first of their kind.
    again = places.groupBy(F.col("_h1").alias("_a1"), F.col("_h2").alias("_a2")).agg(F.count(F.lit(1)).alias("_n"))
    affected = again.join(linked, (F.col("_a1") == F.col("_g1")) & (F.col("_a2") == F.col("_g2")), "left").where("_n > 1 or root is not null")
    affected = store(affected.select("_a1", "_a2", "root", F.coalesce("_n_links", F.lit(0)).cast("long").alias("_links")), "affected")
    found = places.join(affected, (F.col("_h1") == F.col("_a1")) & (F.col("_h2") == F.col("_a2")))
    # A class is a component, or a single line.
    kind = F.struct(F.col("root").isNull().alias("single"), F.coalesce("root", "_h1").alias("x"), F.when(F.col("root").isNull(), F.col("_h2")).alias("y"))
    found = store(found.select("doc_id", "_k1", "_k2", "_pos", "_links", kind.alias("_class")).distinct(), "found")
    first = found.groupBy(F.col("_class").alias("_c")).agg(F.min(_place()).alias("_stays"), F.max(_place()).alias("_last")).where("_stays != _last")
    met = found.join(first, F.col("_class").eqNullSafe(F.col("_c")))
    s = F.col("_stays")
    stays = (s["k1"] == F.col("_k1")) & (s["k2"] == F.col("_k2")) & (s["pos"] == F.col("_pos"))
    name = F.concat_ws(":", F.coalesce(s["id"].cast("string"), F.lit("")), s["pos"])
    gone = met.groupBy(F.col("_k1").alias("_d1"), F.col("_k2").alias("_d2")).agg(
        F.sum("_links").alias("_n_links"),
        F.collect_list(F.when(~stays, F.col("_pos"))).alias("_gone"),
        F.array_sort(F.collect_set(name)).alias("_names"),
    )
    return store(gone, "removals")


def _is_long(min_chars: int):
    return lambda line: F.char_length(F.trim(line)) >= min_chars


def near_equal_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, hot: int = HOT, shorter: bool = False) -> DataFrame:
    """One row per document: n_lines, n_links of them to different lines, n_removed, kept_sha256, classes."""
    joined = _joined(docs.select("doc_id", "text"), edits, min_chars, hot, shorter)
    lines = F.split(F.coalesce("_row.text", F.lit("")), "\n")
    return joined.select(
        "_row.doc_id",
        F.size(F.filter(lines, _is_long(1 if shorter else min_chars))).cast("long").alias("n_lines"),
        F.coalesce("_n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(_left(), 256).alias("kept_sha256"),
        F.coalesce(F.array_join("_names", ","), F.lit("")).alias("classes"),
    )


def _joined(docs: DataFrame, edits: int, min_chars: int, hot: int, shorter: bool) -> DataFrame:
    gone = _removals(docs, edits, min_chars, hot, shorter)
    return _with_keys(docs).join(gone, (F.col("_k1") == F.col("_d1")) & (F.col("_k2") == F.col("_d2")), "left")


def _left() -> Column:
    """The text without the places to remove; the places that stay come from a hashed difference."""
    lines = F.split(F.coalesce("_row.text", F.lit("")), "\n")
    stay = lambda all_lines: F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), "_gone")
    rest = _each(lines, lambda all_lines: F.array_join(F.transform(stay(all_lines), lambda i: F.get(all_lines, i)), "\n"))
    return F.when(F.size("_gone") > 0, rest).otherwise(F.coalesce("_row.text", F.lit("")))


def without_near_equal_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, hot: int = HOT, shorter: bool = False) -> DataFrame:
    """The rows of docs with lines removed; a row that loses all its words with them goes too."""
    joined = _joined(docs, edits, min_chars, hot, shorter)
    text = F.when(F.size("_gone") > 0, _left()).otherwise(F.col("_row.text"))
    left = joined.where(~((F.coalesce(F.size("_gone"), F.lit(0)) > 0) & (F.trim(F.translate(_left(), "\n\t\r", "   ")) == "")))
    return left.select(*[text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
