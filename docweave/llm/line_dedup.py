"""Line dedup: an exact set-similarity join of lines, with DataFrame functions only."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import release, stored

# White space besides the space and the newline; it is read as a space, so that words are split at one character.
OTHER_SPACES = "\t\x0b\x0c\r"

# Hash buckets of the rarity table; a table row is one integer, whatever the number of distinct tokens.
RARITY_BITS = 21

# Lines whose tokens are fetched with a broadcast of their places; more are fetched with a shuffle join.
BROADCAST_LINES = 1_000_000

PLACE = ("doc_id", "line_no")

# Rarest tokens of a class by which it is compared with the first class that has them.
LEADS = 6

# Tokens of a line up to which 64 parities tell lines apart; longer lines are compared in 128.
NARROW = 48

# What a row of a token's list carries besides the class: place, size, position of the token, parities of the tokens.
CARRIED = (*PLACE, "n", "i", "odd", "wide")
LED = (*PLACE, "n", "i", "odd")  # of a lead token


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of (doc_id, text)."""
    # Most texts have none of them; telling so is cheaper than a regular expression over each text.
    other = reduce(or_, (F.contains("text", F.lit(c)) for c in OTHER_SPACES))
    spaced = F.when(other, F.regexp_replace("text", f"[{OTHER_SPACES}]", " ")).otherwise(F.col("text"))
    return docs.select("doc_id", F.posexplode(F.split(spaced, "\n")).alias("line_no", "line"))


def _bucket(token: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(token), 64 - RARITY_BITS).cast("int")


def rarity(docs: DataFrame) -> DataFrame:
    """One row: for every hash bucket its rank, from ``-2 ** (RARITY_BITS - 1)`` on, when buckets are ordered by the number of
    tokens of ``docs`` in them. Rank and bucket are combined by XOR and shifted to the upper bits, which turns the upper
    half of a token's hash into one that starts with the rank in a single step.

    Tokens are counted on the map side; the table has ``2 ** RARITY_BITS`` integers at any input size. Tokens that
    share a bucket are ordered by hash, so the order of tokens is total and the join exact.
    """
    spark = docs.sparkSession
    all_buckets = spark.range(1 << RARITY_BITS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    words = F.split("line", " ")
    counted = lines(docs).select(F.explode(words).alias("t")).filter("t <> ''").select(_bucket(F.col("t")).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    summed = counted.unionByName(all_buckets).groupBy("bucket").agg(F.sum("n").alias("n"))
    # Pairs are packed into one long each: an array of longs takes a fraction of an array of structs.
    low = F.lit((1 << RARITY_BITS) - 1)

    def packed(high: Column, rest: Column) -> Column:
        return F.sort_array(F.collect_list(F.shiftleft(high.cast("bigint"), RARITY_BITS).bitwiseOR(rest.cast("bigint"))))

    most = F.lit((1 << (62 - RARITY_BITS)) - 1)
    ordered = summed.agg(packed(F.least("n", most), F.col("bucket")).alias("x"))
    ranked = ordered.select(F.posexplode("x").alias("rank", "e")).select("rank", F.col("e").bitwiseAND(low).alias("bucket"))
    table = ranked.agg(packed(F.col("bucket"), F.col("rank")).alias("x"))
    half = 1 << (RARITY_BITS - 1)
    turned = F.transform("x", lambda e, bucket: F.shiftleft((e.bitwiseAND(low) - half).cast("int").bitwiseXOR(bucket), 32 - RARITY_BITS))
    return table.select(turned.alias("ranks"))


def _hashes(split: DataFrame, *more: str) -> DataFrame:
    """``split`` with ``hashes``: its distinct tokens as 64-bit hashes, sorted."""
    # Empty parts go by their hash, which is cheaper than comparing texts.
    hashed = F.array_remove(F.transform(F.split("line", " "), lambda t: F.xxhash64(t)), F.xxhash64(F.lit("")))
    return split.select(*more, F.sort_array(F.array_distinct(hashed)).alias("hashes"))


def _keys(hashed: DataFrame, ranks: DataFrame, *more: str | Column) -> DataFrame:
    """``more`` and ``keys``: the tokens of ``hashes`` as 32-bit numbers, rarest first. A number is the rank of the token's bucket,
    followed by the bits of its hash behind the bucket's. They keep the order of tokens; two tokens with one number only make a
    candidate more.

    Functions with a lambda are interpreted together with all that stands below them, so ``hashes`` stays a column of its
    own: ``more`` reads it, too, which keeps Catalyst from moving it. The rank table is a scalar subquery, named beside
    ``more`` and used once, so that Catalyst does move it into the expression; as a column it would be copied for each line.
    """
    upper = F.transform("hashes", lambda h: F.shiftright(h, 32).cast("int"))
    named = hashed.select(*more, upper.alias("upper"), ranks.scalar().alias("ranks"))
    rank = F.transform("upper", lambda h: h.bitwiseXOR(F.coalesce(F.get("ranks", F.shiftrightunsigned(h, 32 - RARITY_BITS)), F.lit(0))))
    return named.select(*(c for c in named.columns if c not in ("upper", "ranks")), F.sort_array(rank).alias("keys"))


def _prefix() -> Column:
    """Rarest tokens of which two lines with Jaccard 4/5 or more share one: n - ceil(4/5 n) + 1 of ``keys``."""
    return F.slice("keys", 1, (F.col("n") - F.expr("(4 * n + 4) div 5") + 1).cast("int"))


def _parities() -> Column:
    """64 bits: each is the parity of the tokens whose lowest 6 bits choose it (a shift reads no others). Where two lines differ
    in a bit, some token is in one of them only, and other bits have other tokens; so they differ in no more bits than tokens."""
    return F.expr("aggregate(keys, 0L, (bits, k) -> bits ^ shiftleft(1L, k))")


def _half_parities() -> Column:
    """The same of the tokens with one more bit set, in lines of more than ``NARROW`` tokens; ``odd ^ wide`` has the others, so
    that both together are 128 parities. In 64, any two long lines differ in few enough bits."""
    half = F.expr("aggregate(keys, 0L, (bits, k) -> if((k & 64) = 0, bits, bits ^ shiftleft(1L, k)))")
    return F.when(F.col("n") > NARROW, half).otherwise(F.lit(0).cast("bigint"))


def _similar(overlap: Column, a: Column, b: Column) -> Column:
    """Jaccard of 4/5 or more in whole numbers; also an upper bound of the overlap can be tested."""
    return overlap * 9 >= (a + b) * 4


def _fetch(docs: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """(id, c1, hashes) of the lines at the places of ``wanted`` (id, doc_id, line_no, c1). Repeated ids have several lines at a
    place; the reader leaves out those whose content isn't ``c1``, since a filter here would be moved below ``_hashes``, and
    each line be split and sorted twice."""
    places = wanted.withColumnsRenamed({"doc_id": "d", "line_no": "l"})
    if count <= BROADCAST_LINES:
        # Only documents with such lines are split.
        of = F.broadcast(places.select("d").distinct())
        docs = docs.join(of, F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
        places = F.broadcast(places)
    found = lines(docs).join(places, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")))
    return stored(_hashes(found, "id", "c1"))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Ids ``x`` of the pairs (x, y) whose Jaccard is 4/5 or more, stored."""
    pairs = stored(pairs)
    ends = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    wanted = stored(classes.join(ends, "id").select("id", "doc_id", "line_no", "c1"))
    sets = _fetch(docs, wanted, wanted.count())
    same = sets.filter(F.xxhash64("hashes") == F.col("c1"))
    left, right = (same.select(F.col("id").alias(side), F.col("hashes").alias(f"hashes_{side}")) for side in "xy")
    overlap = F.size(F.array_intersect("hashes_x", "hashes_y"))
    found = stored(pairs.join(left, "x").join(right, "y").filter(_similar(overlap, F.size("hashes_x"), F.size("hashes_y"))).select("x").distinct())
    release(pairs, wanted, sets)
    return found


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, copy)``: lines with a similar line before them. ``copy``: an earlier line has the same tokens.

    Lines are the parts between newlines, counted from 0; their tokens are the distinct words. Similar is a Jaccard
    of 0.8 or more, judged on the input. Earlier is a smaller doc_id, or the same document and a smaller line.

    1. Lines of the same tokens are one class, and its first line stands for it: copies cost one row.
    2. A class lists its rarest tokens. Similar classes share one of them, early enough for the sizes of both (prefix
       filter), have sizes within 4/5 (length filter), differ in few of 64 or 128 parities of tokens, and the tokens
       behind the shared ones must suffice (positional filter). All of it but the last is part of the join condition,
       so no other pair is shuffled.
    3. Each class is first compared with the first class that has one of its ``LEADS`` rarest tokens. In a group of near copies this settles
       nearly all of them, so the pairs inside the group aren't made.
    4. Classes still open are joined with all earlier ones on their lists. The join's two inputs are plain shuffles,
       so the adaptive skew join splits a hot token.

    Null text, empty lines and lines without a word: never repeated. A null doc_id is the smallest id. Repeated rows
    (same id) have the same places, of which neither is earlier. Empty table: no rows. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ranks = stored(rarity(docs))
    # Lines with a word, told by the text: a filter on ``hashes`` would be moved below them, and each line be split twice.
    hashed = _hashes(lines(docs).filter(F.trim("line") != ""), *PLACE)
    contents = (F.xxhash64("hashes").alias("c1"), F.xxhash64(F.lit(7), "hashes").alias("c2"), F.size("hashes").alias("n"))
    listed = _keys(hashed, ranks, *PLACE, *contents)
    all_lines = stored(listed.select(*PLACE, "c1", "c2", "n", _prefix().alias("prefix"), _parities().alias("odd"), _half_parities().alias("wide")))

    # Same content, same size and prefix.
    shared = ("n", "prefix", "odd", "wide")
    classes = all_lines.groupBy("c1", "c2").agg(F.min(F.struct(*PLACE)).alias("at"), *(F.first(c).alias(c) for c in shared))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("id"), "c1", "c2", "at.*", *shared))

    def postings(tokens: Column) -> DataFrame:
        return classes.select(F.posexplode(tokens).alias("i", "token"), "id", *PLACE, "n", "odd", "wide")

    # The first class of a token is a minimum, combined before the shuffle; joined back, a hot token is split like any other.
    leading = postings(F.slice("prefix", 1, LEADS)).select("token", "id", *LED)
    leads = leading.groupBy("token").agg(F.min(F.struct(*PLACE, "id", *LED[2:])).alias("lead"))
    led = leading.join(leads, "token").select("id", *LED, "lead").filter("lead.id <> id")
    settled = _verified(docs, classes, _pairs(led.select(*_side("x", carried=LED), *_side("y", "lead.", LED)).filter(_before() & _close(_bits("odd"))), leads=True))

    # Both inputs of the join are the same shuffle; what is settled is left out behind it.
    dealt = postings(F.col("prefix")).repartition("token")
    done = settled.select(F.col("x").alias("id"), F.lit(True).alias("done"))
    # An outer join, since an anti join would be moved below the shuffle.
    open_ = dealt.join(F.broadcast(done) if done.count() <= BROADCAST_LINES else done, "id", "left").filter("done IS NULL")
    left, right = open_.select("token", *_side("x")), dealt.select(F.col("token").alias("t"), *_side("y"))
    two = _pairs(left.join(right, (F.col("token") == F.col("t")) & _close(_differ()) & _early() & (F.col("x") != F.col("y")) & _before()))
    verified = _verified(docs, classes, two)
    release(ranks)
    matched = settled.unionByName(verified).distinct()

    marked = classes.join(matched.withColumnRenamed("x", "id").withColumn("hit", F.lit(True)), "id", "left").select(
        "c1", "c2", F.struct(*PLACE).alias("at"), F.coalesce("hit", F.lit(False)).alias("hit")
    )
    copy = F.struct(*PLACE) > F.col("at")
    return all_lines.select(*PLACE, "c1", "c2").join(marked, ["c1", "c2"]).select(*PLACE, copy.alias("copy"), "hit").filter("copy OR hit").drop("hit")


def _side(name: str, of: str = "", carried: tuple[str, ...] = CARRIED) -> list[Column]:
    return [F.col(f"{of}id").alias(name), *(F.col(of + c).alias(f"{c}_{name}") for c in carried)]


def _before() -> Column:
    """y stands before x; a null id is the smallest. No structs are made, since a join tests this for many candidates."""
    of_y, of_x = F.col("doc_id_y"), F.col("doc_id_x")
    smaller = (of_y < of_x) | (of_y.isNull() & of_x.isNotNull())
    return F.coalesce(smaller, F.lit(False)) | (of_y.eqNullSafe(of_x) & (F.col("line_no_y") < F.col("line_no_x")))


def _early() -> Column:
    """Prefix filter for the sizes of both: all that two lines share stands from their first shared token on, which leaves room
    for 4/9 of both sizes. Two lines of one size meet in a ninth of their tokens and one more, not in a fifth."""
    n_x, n_y, i_x, i_y = (F.col(c) for c in ("n_x", "n_y", "i_x", "i_y"))
    return _similar(F.least(n_x - i_x, n_y - i_y), n_x, n_y)


def _bits(column: str) -> Column:
    return F.bit_count(F.col(f"{column}_x").bitwiseXOR(F.col(f"{column}_y")))


def _differ() -> Column:
    """Parities in which x and y differ, of 128 where both have them."""
    others = F.bit_count(F.expr("(odd_x ^ wide_x) ^ (odd_y ^ wide_y)"))
    return F.when(F.least("n_x", "n_y") > NARROW, _bits("wide") + others).otherwise(_bits("odd"))


def _close(differ: Column) -> Column:
    """Length filter; at most a ninth of the sizes' sum may differ, so no more parities; and the positional filter for one
    shared token: at most min(i) + 1 + the rest can be shared."""
    n_x, n_y, i_x, i_y = (F.col(c) for c in ("n_x", "n_y", "i_x", "i_y"))
    length = (n_x * 5 >= n_y * 4) & (n_y * 5 >= n_x * 4)
    # The parities come first: they rule out nearly all pairs.
    return (differ * 9 <= n_x + n_y) & length & _similar(F.least(i_x, i_y) + 1 + F.least(n_x - i_x - 1, n_y - i_y - 1), n_x, n_y)


def _pairs(shared: DataFrame, leads: bool = False) -> DataFrame:
    """(x, y) of rows with one shared token each: the positional filter over all shared tokens.

    What x and y share in the tokens that were compared is counted; all else that they share stands behind the last of
    these, on either side. ``leads``: only the ``LEADS`` rarest tokens are in ``shared``; of longer lines only those with
    two of them in common are tried, since what isn't settled here is left to the full join.
    """
    size = (F.col("n_x") + F.col("n_y")).alias("size")
    rows = shared.select("x", "y", size, F.least(*(F.col(f"n_{c}") - F.col(f"i_{c}") - 1 for c in "xy")).alias("rest"))
    grouped = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.min("rest").alias("rest"), F.max("size").alias("size"))
    if leads:
        grouped = grouped.filter((F.col("shared") >= 2) | (F.col("size") <= 20))
    return grouped.filter((F.col("shared") + F.col("rest")) * 9 >= F.col("size") * 4).select("x", "y")


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut down to the lines that ``repeated_lines`` leaves; the other columns stay as they are.

    A document whose every line with a word goes is dropped; one that had no word stays. Repeated rows are cut alike.
    A column ``n_chars``, if there is one, is not recomputed.
    """
    repeated = stored(repeated_lines(docs, doc_id, text).select(*PLACE).distinct())
    of, went = f"of_{uuid.uuid4().hex}", f"gone_{uuid.uuid4().hex}"  # no column of ``docs`` has these names
    gone = repeated.groupBy(F.col("doc_id").alias(of)).agg(F.collect_list("line_no").alias(went))
    if repeated.count() <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    joined = docs.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col(of)), "left")
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.coalesce(F.array_contains(went, i), F.lit(False)))
    cut = F.when(F.col(went).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    word = F.col(text).rlike(r"[^\x20\x09-\x0D]")
    left = joined.withColumn(text, cut).filter(F.col(went).isNull() | word)
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))
