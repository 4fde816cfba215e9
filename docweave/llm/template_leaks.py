"""Benchmark decontamination by question templates, with DataFrame functions only."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import stored

SEPARATORS = r"[\x20\x09-\x0D]+"

# Characters that don't belong to a word when they stand at one of its ends.
PUNCTUATION = ".,;:!?\"'()[]{}<>|*_`#&%$+=~-"

# Placeholders. No other word of a template can look like them, since words that begin with a digit are numbers.
NUMBER, UNIT, NAME = "0", "1", "2"

# Words that are units behind a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons tonnes lb lbs pound pounds oz ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent dollar dollars cent cents euro euros usd eur degrees celsius fahrenheit kelvin "
    "w kw watt watts v volt volts hz khz mhz ghz kb mb gb tb bit bits byte bytes mph kph"
).split()

# Words of a window, literal words it must have, and matched words in one alignment that make a leak.
WINDOW, LITERALS, RUN, SHARE = 5, 2, 13, 0.8

# Template windows of the benchmark that are broadcast at a time.
BLOCK_WINDOWS = 200_000

# Document ids that are broadcast to drop rows; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _typed(bare: Column, lowered: Column, bare_before: Column, before: Column) -> Column:
    """Template word: a placeholder, the word in lower case without punctuation around it, or '' for punctuation."""
    digit = lambda w: F.ascii(w).between(48, 57)
    first = F.ascii(bare)
    # A capital inside a sentence; words in capitals throughout are shouted, not names.
    head = F.substring(bare, 1, 1)
    capital = first.between(65, 90) | ((first > 127) & (head != F.lower(head)))
    inside = before.isNotNull() & ~F.substring(before, -1, 1).isin(".", "!", "?", ":")
    return (
        F.when(digit(bare), F.lit(NUMBER))
        .when(capital & inside & (bare != F.upper(bare)), F.lit(NAME))
        .when(F.coalesce(digit(bare_before), F.lit(False)) & lowered.isin(UNITS), F.lit(UNIT))
        .otherwise(lowered)
    )


def templates(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, template, bare, starts) of rows with ``text``: template words, the words they stand for, and where slots start.

    A slot is a literal word or a run of placeholders of one family (names; numbers with their units), so that ``80 km`` and
    ``80km``, or ``Peter`` and ``Hans Meier``, are one slot each. Every step is a column of its own, so a word is trimmed,
    lowered and typed once.
    """
    split = rows.select(*keys, F.array_remove(F.split(F.coalesce("text", F.lit("")), SEPARATORS), "").alias("words"))
    trimmed = split.select(*keys, "words", F.transform("words", lambda w: F.btrim(w, F.lit(PUNCTUATION))).alias("trimmed"))
    lowered = trimmed.select("*", F.transform("trimmed", lambda w: F.lower(w)).alias("lowered"))
    typed = F.transform("trimmed", lambda w, i: _typed(w, F.get("lowered", i), F.get("trimmed", i - 1), F.get("words", i - 1)))
    # Punctuation is dropped from both lists alike.
    made = lowered.select(*keys, F.array_remove(typed, "").alias("template"), F.array_remove("lowered", "").alias("bare"))

    def goes_on(i: Column) -> Column:
        word, before = F.get("template", i), F.coalesce(F.get("template", i - 1), F.lit(""))
        return word.isin(NUMBER, UNIT, NAME) & before.isin(NUMBER, UNIT, NAME) & ((word == NAME) == (before == NAME))

    return made.withColumn("starts", F.filter(_upto(F.size("template") - 1), lambda i: ~goes_on(i)))


def _upto(last: Column) -> Column:
    """0, 1, ..., ``last``; nothing for a negative number."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashed(rows: DataFrame, window: int) -> DataFrame:
    """``rows`` with ``places`` and ``hashes``, one of every window of slots; none for a text with fewer. Slots are hashed once,
    and a window's hash is made of those of its slots."""
    each = rows.withColumn("_each", F.transform("starts", lambda i: F.xxhash64(F.get("template", i))))
    placed = each.withColumn("places", _upto(F.size("starts") - window))
    return placed.withColumn("hashes", F.transform("places", lambda i: F.xxhash64(*(F.get("_each", i + k) for k in range(window))))).drop("_each")


def _slots(at: Column, window: int) -> Column:
    """(kind, value) of the ``window`` slots from ``at``; the words of a run are joined."""

    def one(p: Column) -> Column:
        first = F.get("starts", p)
        size = F.coalesce(F.get("starts", p + 1), F.size("template")) - first
        return F.struct(F.get("template", first).alias("kind"), F.array_join(F.slice("bare", first + 1, size), "").alias("value"))

    return F.transform(F.sequence(at, at + (window - 1)), one)


def _kinds(slots: str) -> Column:
    return F.transform(slots, lambda s: s["kind"])


def _key(kind: Column, value: Column) -> Column:
    """What has to be consistent in a slot: a name, or a number without its unit."""
    return F.when(kind == NAME, value).otherwise(F.regexp_extract(value, r"^[0-9][0-9.,:/]*", 0))


# Bits of the table that tells which windows may be in the benchmark; 16,384 numbers of 64 bits.
TABLE_BITS = 20


def _bit_table(known: DataFrame) -> DataFrame:
    """One row ``bits``: for every hash of ``known`` the bit is set that its highest ``TABLE_BITS`` bits name."""
    place = F.shiftrightunsigned("hash", 64 - TABLE_BITS).cast("int")
    words = known.sparkSession.range(1 << (TABLE_BITS - 6)).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bit"))
    bits = known.select(place.alias("place")).selectExpr("shiftright(place, 6) AS word", "shiftleft(1L, place & 63) AS bit")
    summed = bits.unionByName(words).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    return summed.agg(F.sort_array(F.collect_list(F.struct("word", "bit"))).alias("x")).select(F.transform("x", lambda e: e["bit"]).alias("bits"))


def benchmark_windows(benchmark: DataFrame, window: int, literals: int) -> DataFrame:
    """(hash, item_id, variant, item_words, item_pos, theirs, reach): the template windows of the benchmark, ``theirs``
    being the slots of a window and ``reach`` the numbers of its words.

    Items of equal text are one item, named by the least id. Variant 0 is the item as it stands, variant 1 the item in lower
    case, which matches copies in lower case or in capitals throughout, where no word can be told to be a name. Windows with fewer
    than ``literals`` literal words, which any list of numbers or names would match, are left out.
    """
    items = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    variants = items.select("item_id", F.posexplode(F.array_distinct(F.array("text", F.lower("text")))).alias("variant", "text"))
    made = _hashed(templates(variants, "item_id", "variant"), window)
    # An outer generator keeps the arrays from being copied, and computed once more, into a filter below it.
    rows = made.select("item_id", "variant", "template", "bare", "starts", F.posexplode_outer("hashes").alias("item_pos", "hash")).filter("hash IS NOT NULL")
    stop = F.coalesce(F.get("starts", F.col("item_pos") + window), F.size("template"))
    cut = rows.select(
        "hash",
        "item_id",
        "variant",
        F.size("template").alias("item_words"),
        "item_pos",
        _slots(F.col("item_pos"), window).alias("theirs"),
        F.sequence(F.get("starts", "item_pos"), stop - 1).alias("reach"),
    )
    return cut.filter(F.size(F.filter("theirs", lambda s: ~s["kind"].isin(NUMBER, UNIT, NAME))) >= literals)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    literals: int = LITERALS,
    run: int = RUN,
    share: float = SHARE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``(doc_id, item_id, item_words, covered, n_slots, reparameterised)``: documents that hold a benchmark item, one row
    for each pair.

    Numbers, names and units become placeholders on both sides, and a run of them one slot. Windows of ``window`` slots meet by a
    hash join; equal hashes are verified by the slots. Matches of one document and item with the same shift are one
    alignment. An alignment counts if its slots are consistent, i.e. each benchmark value in a placeholder has one
    value in the document, and if it covers ``share`` of the item's words, or ``run`` of them in a long item. An item in lower case
    or in capitals throughout is matched word by word.
    ``reparameterised``: some slot holds another value than in the benchmark.

    The benchmark is cut into blocks of about ``block_windows`` windows by hash, each broadcast in turn, so that the documents are
    never shuffled: only matches are. Nothing is broadcast that grows with the corpus.

    Null text on either side: matches nothing, like an item shorter than ``window`` slots. Repeated documents or
    repeated rows: one result row for each different doc_id and item; repeated items: the least item_id. Null doc_id: a
    document like others, reported under null. Empty tables: no rows. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    known = benchmark_windows(items, window, literals)
    blocks = max(1, -(-known.count() // block_windows))
    made = templates(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id")
    # A row's own number keeps documents with the same id apart.
    hashed = _hashed(made.select(F.monotonically_increasing_id().alias("row"), "*"), window)
    # Only windows that the bit table doesn't rule out become rows; the table is a scalar subquery of a fixed size.
    hashed = hashed.withColumn("bits", _bit_table(known).scalar())
    # A shift by more than 63 counts modulo 64.
    maybe = F.expr(
        f"transform(filter(places, i -> shiftright(bits[cast(shiftrightunsigned(hashes[i], {64 - TABLE_BITS + 6}) AS INT)],"
        f" cast(shiftrightunsigned(hashes[i], {64 - TABLE_BITS}) AS INT)) & 1L = 1L), i -> struct(i AS pos, hashes[i] AS hash))"
    )
    exploded = hashed.select("row", "doc_id", "template", "bare", "starts", F.inline_outer(maybe)).filter("hash IS NOT NULL")

    def matches(block: DataFrame) -> DataFrame:
        met = exploded.join(F.broadcast(block), "hash").withColumn("ours", _slots(F.col("pos"), window)).filter(_kinds("ours") == _kinds("theirs"))
        pairs = F.filter(F.arrays_zip("theirs", "ours"), lambda s: s["theirs"]["kind"].isin(NUMBER, UNIT, NAME))

        def judged(s: Column) -> Column:
            kind, theirs, ours = s["theirs"]["kind"], s["theirs"]["value"], s["ours"]["value"]
            return F.struct(kind.alias("kind"), _key(kind, theirs).alias("theirs"), _key(kind, ours).alias("ours"), (theirs == ours).alias("same"))

        return met.select(
            "row", "doc_id", "item_id", "variant", "item_words", (F.col("pos") - F.col("item_pos")).alias("shift"), "reach", F.transform(pairs, judged).alias("slots")
        )

    of_block = F.pmod(F.xxhash64(F.col("hash"), F.lit(3)), F.lit(blocks))
    found = reduce(DataFrame.unionByName, [matches(known.filter(of_block == b) if blocks > 1 else known) for b in range(blocks)])
    aligned = found.groupBy("row", "doc_id", "item_id", "variant", "item_words", "shift").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("reach")))).alias("covered"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots")
    )
    values = F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["theirs"])))
    mapped = F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["theirs"], s["ours"])))
    judged = aligned.select(
        "doc_id",
        "item_id",
        "item_words",
        "covered",
        F.size(mapped).alias("n_slots"),
        (F.size(values) == F.size(mapped)).alias("consistent"),
        F.exists("slots", lambda s: ~s["same"]).alias("reparameterised"),
    )
    enough = F.col("covered") >= F.least(F.lit(run), F.ceil(F.col("item_words") * share))
    best = F.max(F.struct("covered", (~F.col("reparameterised")).alias("same"), "n_slots")).alias("best")
    return (
        judged.filter("consistent")
        .filter(enough)
        .groupBy("doc_id", "item_id", "item_words")
        .agg(best)
        .select("doc_id", "item_id", "item_words", "best.covered", "best.n_slots", (~F.col("best.same")).alias("reparameterised"))
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that ``leaks`` reports; columns stay as they are."""
    return without_ids(docs, leaks(docs, benchmark, doc_id, **options).select("doc_id"), doc_id)


def without_ids(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the ids in the one column of ``gone``; null is an id like others."""
    name = f"gone_{uuid.uuid4().hex}"  # no column of ``docs`` has this name
    gone = stored(gone.toDF(name).distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col(name)), "left_anti")
