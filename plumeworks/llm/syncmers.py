"""Document fingerprints from closed syncmers, in DataFrame operations only.

A k-mer (``K`` code points in a row) is chosen when its smallest inner substring (``S`` code points, compared by hash) stands
at its first or last place. Whether it is chosen depends on the k-mer alone, so equal passages give equal anchors whatever
surrounds them; of any ``K - S`` k-mers in a row at least one is chosen. A fingerprint lists the anchors in order, each as
``gap:hash``: the distance from the anchor before it (from the text's begin for the first), and 32 bits that name the
k-mer. Texts shorter than ``2 * K`` list every inner substring instead, texts shorter than ``S`` themselves, so every text
but the empty one has an anchor.

Matching is positional: a step is an anchor, the anchor before it and the distance between them, and two fingerprints are
alike by the Jaccard similarity of their sets of steps. Insertions shift what follows without harm.

Texts are cut into blocks of ``BLOCK`` k-mers, which overlap by one k-mer less one, so work and memory grow linearly with the
length of a text. A block is a row, and each of its inner substrings a column: Spark compiles comparisons of columns, but
interprets functions of array elements. An edited text keeps the anchors of the part it keeps; only the rest is read again.

The next document comes by a window over blocks of ids, not over one sorted table: blocks follow quantiles of the ids, an id
with more than ``HOT`` rows is cut further by its texts' hashes, and the first rows of a block also go to the block before it.
Each text crosses the network once.

Defined results: every row is a document; a null text counts as empty; order is by id (null first), then by two hashes of
the text, and the first follows the last, so a single document follows itself; two empty fingerprints are alike (1.0), an
empty and another are not (0.0); an empty table gives an empty result. Other columns are not read. Rows of one id with one
text are interchangeable and stay in one block. Collisions of the 32 bits are not verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import counted_within, lookup_join
from ..operators.ordering import blocks_for, quantile_blocks
from ..session import materialise

#: Code points of a k-mer and of an inner substring, and inner substrings of a k-mer.
K, S = 31, 8
WINDOW = K - S + 1
#: k-mers of a block, its inner substrings, and how many of those are cut from one segment of it.
BLOCK, SEGMENT = 96, 17
PLACES = BLOCK + WINDOW - 1
#: Rows of one id from which the id is cut by hash, into 2 ** HOT_BITS blocks.
HOT, HOT_BITS = 20_000, 10
LOW = (1 << 32) - 1
#: Stands before the first anchor of a text; greater than every anchor.
NONE = (1 << 63) - 1


def _anchor(position: Column, name: Column) -> Column:
    """Position and 32 bits of a name in one number."""
    return F.shiftleft(position.cast("long"), 32).bitwiseOR(name.bitwiseAND(F.lit(LOW)))


def _short(text: Column) -> Column:
    """Anchors of a text of less than two k-mers: every inner substring, or the text itself."""
    inner = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{S}}}))."), F.lit(1))
    every = F.transform(inner, lambda x, i: _anchor(i, F.xxhash64(x)))
    return F.when(F.char_length(text) >= S, every).when(text != "", F.array(_anchor(F.lit(0), F.xxhash64(text)))).otherwise(F.array().cast("array<long>"))


def _blocks_of(text: Column, start: Column, edit: bool) -> Column:
    """``BLOCK`` code points each with the ``K - 1`` after them: ``edit``, place ``at`` (from ``start``) and ``piece``."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{BLOCK + K - 1}}})).{{1,{BLOCK}}}"), F.lit(1))
    return F.transform(pieces, lambda piece, i: F.struct(F.lit(edit).alias("edit"), (start + i * BLOCK).alias("at"), piece.alias("piece")))


def with_anchors(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``found``, the anchors of ``piece`` (``at`` and after) in order, instead of ``piece``.

    Each inner substring's hash is a column, so the comparisons are compiled, not interpreted for each element of an array.
    """
    kept = [f"`{c}`" for c in blocks.columns if c != "piece"]
    segments = [f"substring(piece, {i + 1}, {SEGMENT + S - 1}) AS _s{i // SEGMENT}" for i in range(0, PLACES, SEGMENT)]
    hashes = [f"xxhash64(substring(_s{i // SEGMENT}, {i % SEGMENT + 1}, {S})) AS _h{i}" for i in range(PLACES)]
    lows = [f"least({', '.join(f'_h{i + j}' for j in range(S))}) AS _m{i}" for i in range(PLACES - S + 1)]

    def chosen(i: int) -> str:
        least = ", ".join(f"_m{i + j}" for j in range(0, WINDOW, S))
        name = ", ".join(f"_h{i + j}" for j in [*range(0, WINDOW, S), WINDOW - 1])  # they cover the k-mer
        return f"CASE WHEN _n >= {i + K} AND least({least}) IN (_h{i}, _h{i + WINDOW - 1}) THEN shiftleft(at + {i}, 32) | (xxhash64({name}) & {LOW}) ELSE -1L END"

    cut = blocks.selectExpr(*kept, "char_length(piece) AS _n", *segments)
    least = cut.selectExpr(*kept, "_n", *hashes).selectExpr("*", *lows)
    return least.selectExpr(*kept, f"array_remove(array({', '.join(chosen(i) for i in range(BLOCK))}), -1L) AS found")


def _with_before(found: Column, before: Column, body) -> Column:
    """``body`` of each anchor and the one before it; ``before`` comes before the first."""
    return F.zip_with(found, F.slice(F.concat(F.array(before), found), 1, F.size(found)), body)


def steps(found: Column, before: Column) -> Column:
    """What positional matching compares: a number for each anchor with the one before it (``NONE`` if there is none) and their distance.

    The difference gives distance and name of the one before, and is negative only without one.
    """
    return _with_before(found, before, lambda a, b: F.xxhash64(a.bitwiseAND(F.lit(LOW)), a - b))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct steps."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def written(found: Column, before: Column) -> Column:
    """The items of a fingerprint as texts; ``before`` is 0 if there is no anchor before the first."""
    gap = lambda a, b: (F.shiftright(a, 32) - F.shiftright(b, 32)).cast("string")
    return _with_before(found, before, lambda a, b: F.concat(gap(a, b), F.lit(":"), F.lpad(F.hex(a.bitwiseAND(F.lit(LOW))), 8, "0")))


def _blocks(rows: DataFrame, hot: int) -> DataFrame:
    """``rows`` with ``block``, which grows with ``place`` (id known, id, two hashes of the text)."""
    # rounding to double keeps the order, and so do null ids below all others
    valued = rows.withColumn("_x", F.when(F.col("place.known"), F.col("place.id").cast("double")).otherwise(-1e19))
    cut = quantile_blocks(valued, "_x", "_b", 4 * blocks_for(rows.select("place").count())).drop("_x").withColumn("_id", F.struct("place.known", "place.id"))
    often = cut.groupBy("_b", "_id").agg(F.count("*").alias("n")).where(F.col("n") > hot).groupBy("_b").agg(F.sort_array(F.collect_list("_id")).alias("_hot"))
    often = materialise(often, "hot-ids")  # at most one id for each ``hot`` rows, in most tables none
    if often.isEmpty():
        return cut.withColumn("block", F.struct("_b", F.lit(0).alias("s"), F.lit(0).cast("long").alias("t"))).drop("_b", "_id")
    cut = lookup_join(cut, often, ["_b"], max_lookup_rows=0 if counted_within(often) else None, salt_on=["place"])
    is_hot = F.coalesce(F.array_contains("_hot", F.col("_id")), F.lit(False))
    below = F.coalesce(F.size(F.filter("_hot", lambda x: x < F.col("_id"))), F.lit(0))
    part = F.when(is_hot, F.shiftright("place.h1", 64 - HOT_BITS)).otherwise(0)
    return cut.withColumn("block", F.struct("_b", (2 * below + is_hot.cast("int")).alias("s"), part.alias("t"))).drop("_b", "_id", "_hot")


def with_next(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """to, row, extra, doc_id, text, next_text: every row with the text of the row after it.

    ``to`` is its block and ``row`` its place there; the last row of a block is ``extra``, the first of the next block.
    """
    own_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    place = F.struct(own_id.isNotNull().alias("known"), F.coalesce(own_id, F.lit(0)).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    rows = _blocks(documents.select(place.alias("place"), text.alias("text")), hot)
    firsts = materialise(rows.groupBy("block").agg(F.min("place").alias("place")), "block-begins")  # a few numbers for each block
    ordered = Window.orderBy("block")
    before = firsts.select("block", "place", F.coalesce(F.lag("block").over(ordered), F.last("block").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("previous"))
    marked = lookup_join(rows, before, ["block", "place"], max_lookup_rows=0 if counted_within(firsts) else None, salt_on=["place"])
    also = F.when(F.col("previous").isNotNull(), F.array(F.struct(F.col("previous").alias("to"), F.lit(True).alias("extra")))).otherwise(F.array())
    sent = marked.select("place", "text", F.inline(F.concat(F.array(F.struct(F.col("block").alias("to"), F.lit(False).alias("extra"))), also)))
    # anchors are computed after the shuffle, so only texts cross the network
    order = Window.partitionBy("to").orderBy("extra", "place")
    return sent.repartition("to").select(
        "to", F.row_number().over(order).alias("row"), "extra", F.when(F.col("place.known"), F.col("place.id")).alias("doc_id"),
        "text", F.lead("text").over(order).alias("next_text"),
    )


def with_found(rows: DataFrame) -> DataFrame:
    """to, row and ``about`` of ``rows`` (to, row, about, text, edited, start) with ``found``, anchors of the whole text, and those of
    the edited text, whose first ``start + K - 1`` code points are those of the text: the first ``same`` of ``found``, then ``rest``.

    Texts go as blocks through ``with_anchors`` and are put together by their rows; all of a row stays in its task.
    """
    none = F.array().cast("array<struct<edit:boolean,at:bigint,piece:string>>")
    long_text, long_edited = F.char_length("text") >= 2 * K, F.char_length("edited") >= 2 * K
    rest = F.substring("edited", F.col("start").cast("int") + 1, F.char_length("edited"))
    parts = F.concat(
        F.when(long_text, _blocks_of(F.col("text"), F.lit(0).cast("long"), False)).otherwise(none),
        F.when(long_edited, _blocks_of(rest, F.col("start"), True)).otherwise(none),
    )
    short = F.when(~long_text, _short(F.col("text"))), F.when(~long_edited, _short(F.col("edited")))
    # a selection of its own: beside the explode, Spark would carry whole texts into the rows of their blocks
    cut = rows.select("to", "row", F.struct("about", "start", short[0].alias("text"), short[1].alias("edited")).alias("_of"), parts.alias("_parts"))
    parted = cut.select("to", "row", "_of", F.posexplode_outer("_parts").alias("_i", "_part"))
    once = F.when(F.coalesce(F.col("_i"), F.lit(0)) == 0, F.col("_of"))  # what is known of a text goes with its first block
    anchored = with_anchors(parted.select("to", "row", once.alias("_of"), "_part.*"))

    def of(which: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(which, F.struct("at", "found"))))
        return F.flatten(F.transform(listed, lambda x: x["found"]))

    each = anchored.groupBy("row", "to").agg(F.first("_of", ignorenulls=True).alias("_of"), of(~F.col("edit")).alias("_own"), of(F.col("edit")).alias("_rest"))
    each = each.select("to", "row", "_of.*", F.coalesce("_of.text", "_own").alias("found"), "_rest").withColumn("start", F.shiftleft("start", 32))
    same = F.when(F.col("edited").isNull(), F.size(F.filter("found", lambda a: a < F.col("start")))).otherwise(0)
    return each.select("to", "row", "about", "found", same.alias("same"), F.coalesce("edited", "_rest").alias("rest"))


def fingerprint_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points replaced by as many first ones of the next document.
    """
    n = F.char_length("text")
    rows = with_next(documents, id_col, text_col, hot).withColumn("n_chars", n.cast("long")).withColumn("quarter", F.floor(n / 4).cast("int"))
    rows = rows.withColumn("kept", n - F.col("quarter")).withColumn("start", F.greatest(F.col("kept") - K + 1, F.lit(0)).cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("kept")), F.substring("next_text", F.lit(1), F.col("quarter")))
    rows = rows.withColumn("edited", F.when(F.col("extra"), "").otherwise(edited))  # an extra row's own steps are all that is asked for
    about = F.struct("extra", "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    found = with_found(rows.select("to", "row", about.alias("about"), "text", "edited", "start"))

    def with_edited(df: DataFrame, made: str, of, none: int) -> DataFrame:
        """``made`` of the text's anchors, and of the edited text's as ``edited``; what both have is made once."""
        none = F.lit(none).cast("long")
        last = F.coalesce(F.get("found", F.col("same") - 1), none)
        return df.withColumn(made, of(F.col("found"), none)).withColumn("edited", F.concat(F.slice(made, 1, F.col("same")), of(F.col("rest"), last)))

    found = with_edited(found, "own", steps, NONE).withColumn("own", F.array_distinct("own")).withColumn("edited", F.array_distinct("edited"))
    found = found.withColumn("near_edited", likeness(F.col("own"), F.col("edited"))).drop("edited")
    found = found.withColumn("next_own", F.lead("own").over(Window.partitionBy("to").orderBy("row"))).where(~F.col("about.extra"))
    found = with_edited(found, "items", written, 0)
    text = lambda items: F.lower(F.array_join(items, ","))
    return found.select(
        "about.doc_id", "about.n_chars", "about.edited_sha256", text("items").alias("fingerprint"), text("edited").alias("edited_fingerprint"),
        "near_edited", likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
