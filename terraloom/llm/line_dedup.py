"""Line dedup by an exact set-similarity join (operator 1), on DataFrame functions only."""

from __future__ import annotations

import math
import uuid
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import drop, saved, text_print, texts_by_id

BUCKETS = 1 << 18  # of the word counts that order tokens; a table of fixed size, one byte each
COMMON = 18  # rarity level from which a prefix token is too common to be a key alone: some 512 words in its bucket
CELLS = 10  # a line, that one round of the candidate join shuffles at most, as far as the words deal them evenly
FAST_MAP = "spark.sql.codegen.aggregate.fastHashMap.capacityBit"
LAST = (1 << 63) - 1  # stands for a null id: such documents come after all others
PLACE = 32  # bits of a line's number that count the lines of one text; those above count the texts of one id


def _spaced(text: Column, marks: str = "\t\x0b\x0c\r") -> Column:
    """The text with blanks for other ASCII white space. Few texts have any, and looking for it costs less than replacing."""
    some = reduce(lambda x, y: x | y, (text.contains(mark) for mark in marks))
    return F.when(some, reduce(lambda x, mark: F.replace(x, F.lit(mark), F.lit(" ")), marks, text)).otherwise(text)


def _levels(docs: DataFrame) -> tuple[Column, int]:
    """A constant array: for every hash bucket the logarithm of the count of its words over all texts, in halves of a doubling; and the level
    that splits these words in halves."""
    words = docs.select(F.explode(F.split(F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    seen = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")).count()
    level = F.least(F.lit(126), F.floor(2 * F.log2(F.col("count") + 1))).cast("tinyint")
    all_ = seen.groupBy().agg(F.sort_array(F.collect_list(F.struct("bucket", level.alias("level")))).alias("rows")).select("rows.bucket", "rows.level")
    spark = docs.sparkSession
    before = spark.conf.get(FAST_MAP, None)
    spark.conf.set(FAST_MAP, "19")  # all buckets fit Spark's fast map of an aggregate, which else takes 65,536 keys
    try:
        rows = all_.first()
    finally:
        spark.conf.unset(FAST_MAP) if before is None else spark.conf.set(FAST_MAP, before)
    table, mass = [0] * BUCKETS, [0.0] * 127  # of fixed size, whatever the corpus
    for bucket, value in zip(rows["bucket"], rows["level"], strict=True):
        table[bucket] = value
        mass[value] += 2.0 ** (value / 2)
    middle = next(i for i, below in enumerate(accumulate(mass)) if 2 * below >= sum(mass))
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<tinyint>"), middle  # folded to a constant before it runs


def _need(n: Column, percent: int) -> Column:
    """Least overlap that a set of n tokens needs with any set that reaches the limit."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _words(line: Column) -> Column:
    """Different hashes of the words of a line whose white space is blanks."""
    return F.array_except(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit(""))))


def _parity(s: Column) -> Column:
    """Parities of tokens by 64 hash cells."""
    one = F.lit(1).cast("long")
    return F.aggregate(s, F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))))


def _lines(docs: DataFrame, levels: Column, middle: int, percent: int) -> DataFrame:
    """A row for each line with words: place, fingerprint of its set, size, parity bits, and prefix tokens with one more.

    A token's key has its rarity level above and 56 bits of the word's hash below; the prefix holds the least keys. Rare tokens and common ones, below
    the level ``middle`` and from it on, have 64 parity bits each. A mark sorted in among them tells where the common ones begin, so each token is taken once.
    """
    mark = F.lit(middle << 56)
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 31  # smaller sets reach the limit with no other set

    def key(h: Column) -> Column:
        level = F.coalesce(F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("long"), F.lit(0))  # never null: so keys sort as primitives
        return F.shiftleft(level, 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))

    # array functions inside a lambda function's argument are interpreted: so they stand outside, or in a select of their own
    each = docs.select("doc_id", "nth", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("at", "line")).where("trim(line) != ''")
    keys = F.array_except(F.transform(F.transform(F.split("line", " "), lambda w: F.xxhash64(w)), key), F.array(key(F.xxhash64(F.lit("")))))
    sets = each.select("doc_id", _pos(F.col("nth"), F.col("at")).alias("pos"), F.sort_array(F.concat(keys, F.array(mark))).alias("s"))
    m = F.array_position("s", mark).cast("int")
    sets = sets.select("doc_id", "pos", "s", F.slice("s", F.lit(1), m - 1).alias("rare"), F.slice("s", m + 1, F.size("s")).alias("common"))
    n = F.size("rare") + F.size("common")
    least_keys = F.slice("s", F.lit(1), n - _need(n, percent) + 3)
    return sets.select(
        "doc_id",
        "pos",
        F.xxhash64("s").alias("f1"),
        F.xxhash64(F.lit(1), "s").alias("f2"),
        n.alias("n"),
        _parity(F.col("rare")).alias("rare"),
        _parity(F.col("common")).alias("common"),
        F.when(n >= least, F.slice(F.array_remove(least_keys, mark), F.lit(1), n - _need(n, percent) + 2)).alias("prefix"),
    )


def _pos(nth: Column, at: Column) -> Column:
    """The number of a line among all of its id: ascends by text, then by place."""
    return F.shiftleft(nth.cast("long"), PLACE).bitwiseOR(at.cast("long"))


def _place(pos: Column) -> Column:
    return pos.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")


def _picked(items: Column, places: Column) -> Column:
    """The items of an array at the given places. The array is bound to a variable first, or it would be made anew for each place."""
    return F.transform(F.array(items), lambda x: F.transform(places, lambda i: F.get(x, i)))[0]


def _numbered(docs: DataFrame, doc: str, nth: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a document number ``doc`` (the id, LAST for null) and ``nth``, which numbers the different texts of one id from 0; and the
    documents themselves (doc_id, nth, text) without null texts.

    Rows of one id and text are one document. Only ids that repeat are joined in; where none does, nothing is.
    """
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    several = texts_by_id(docs.where("text is not null"), id_, F.col("text"))

    def documents(rows: DataFrame) -> DataFrame:
        return rows.where("text is not null").select(F.col(doc).alias("doc_id"), F.col(nth).alias("nth"), F.col("text").cast("string").alias("text"))

    if several is None:
        all_ = docs.withColumns({doc: id_, nth: F.lit(0).cast("long")})
        return all_, documents(all_)
    ranks = several.select(F.col("id").alias(doc), F.col("print").alias("_print"), F.col("rank").alias(nth))
    left = docs.withColumn(doc, id_)
    found = left.join(ranks, (left[doc] == ranks[doc]) & (text_print(left["text"]) == ranks["_print"]), "left")
    all_ = found.select(*(left[c] for c in left.columns), F.coalesce(ranks[nth], F.lit(0).cast("long")).alias(nth))
    return all_, documents(all_).dropDuplicates(["doc_id", "nth"])


def _differ() -> Column:
    """Parity bits in which lines a and b differ: never more than the words that one of them lacks."""
    rare, common = (F.bit_count(F.col(f"a.{x}").bitwiseXOR(F.col(f"b.{x}"))) for x in ("rare", "common"))
    return rare + common


def _alike(na: Column, nb: Column, percent: int, shared: Column | None = None) -> Column:
    """Whether lines a and b of such sizes may reach the limit, b being the earlier: by parity bits, length and the places of a shared token."""
    # a Jaccard similarity of p/100 needs an overlap of p / (100 + p) of both sizes
    fits = _differ() * (100 + percent) <= (na + nb) * (100 - percent)
    fits = fits & (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
    if shared is not None:
        fits = fits & (shared * (100 + percent) >= (na + nb) * percent)
    return fits & ((F.col("b.doc_id") < F.col("a.doc_id")) | ((F.col("b.doc_id") == F.col("a.doc_id")) & (F.col("b.pos") < F.col("a.pos"))))


def _pair() -> list[Column]:
    return [F.col("a.doc_id"), F.col("a.pos"), F.col("b.doc_id").alias("doc_b"), F.col("b.pos").alias("pos_b")]


def _firsts(sets: DataFrame, percent: int) -> DataFrame:
    """For each line the likeliest match: of the earliest lines that share two neighbours in the rarity order of their prefixes.

    Half of the pairs of neighbours serve, chosen by their hash, so that like lines choose alike wherever the pairs stand.
    """
    size = F.size("prefix") - 1
    neighbours = sets.where("prefix is not null").select("doc_id", "pos", "n", "rare", "common", "prefix", F.posexplode(F.slice("prefix", F.lit(1), size)).alias("i", "tok"))
    zero = F.lit(0).cast("long")
    plain = [F.coalesce(c, zero).alias(c) for c in ("doc_id", "pos", "rare", "common")]
    cells = neighbours.select(*plain, F.coalesce("n", F.lit(0)).alias("n"), F.xxhash64("tok", F.get("prefix", F.col("i") + 1)).alias("key"))
    # what both sides of the join read is the same and never null: so one shuffle serves both
    cells = cells.where("key % 2 = 0").repartition("key")
    heads = cells.groupBy("key").agg(F.min(F.struct("doc_id", "pos", "n", "rare", "common")).alias("head"), F.count("*").alias("size")).where("size > 1").select("key", "head.*")
    on = (F.col("a.key") == F.col("b.key")) & _alike(F.col("a.n"), F.col("b.n"), percent)
    pairs = cells.alias("a").join(heads.alias("b").hint("shuffle_hash"), on).select(*_pair(), _differ().alias("differ"))
    return pairs.groupBy("doc_id", "pos").agg(F.min(F.struct("differ", "doc_b", "pos_b")).alias("b")).select("doc_id", "pos", "b.doc_b", "b.pos_b")


def _rounds(sets: DataFrame) -> int:
    """In how many rounds the candidates of open lines are looked for, so that the cells of one are no more than CELLS a line.

    The larger the corpus, the more words are common, and a line of common words has a cell for each two of its prefix. Rounds bound what is shuffled at once.
    """
    size = F.size("prefix")
    rare = F.size(F.filter("prefix", lambda t: t < COMMON << 56))
    pairs = (size - rare) * (size - rare - 1) / 2
    cells, lines = sets.where("prefix is not null").agg(F.sum(F.least(rare, size - 1) + pairs), F.count("*")).first()
    return max(1, math.ceil((cells or 0) / (CELLS * max(lines, 1))))


def _candidates(sets: DataFrame, percent: int, part: int = 0, rounds: int = 1) -> DataFrame:
    """Pairs (later, earlier) with a shared prefix key, for lines that are still ``open``; of all ``rounds`` of keys those of round ``part``.

    A rare prefix token is a key. With a common one as the first token that two lines share, the second that they
    share lies in the prefix with one more token: so the key is the common token and any later one. The token tells the round.
    """
    size = F.size("prefix")
    tokens = sets.where("prefix is not null").select("doc_id", "pos", "n", "rare", "common", "open", "prefix", F.posexplode(F.slice("prefix", F.lit(1), size - 1)).alias("i", "tok"))
    if rounds > 1:
        tokens = tokens.where(F.pmod(F.col("tok"), F.lit(rounds)) == part)
    common = F.call_function("shiftrightunsigned", F.col("tok"), F.lit(56)) >= COMMON
    rest = F.when(common, F.slice("prefix", F.col("i") + 2, size)).otherwise(F.array(F.lit(0).cast("long")))
    cells = tokens.select("doc_id", "pos", "n", "rare", "common", "open", "prefix", "i", "tok", F.posexplode(rest).alias("j", "next"))
    before = F.when(F.col("i") > 0, F.get("prefix", F.col("i") - 1))
    between = F.when(F.col("j") > 0, F.get("prefix", F.col("i") + F.col("j")))
    # what both sides of the join read is the same (size, place and state ride in one number) and never null: so one shuffle serves both
    size = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft((F.col("i") + 1).cast("long"), 1)).bitwiseOR(F.col("open").cast("long"))
    zero = F.lit(0).cast("long")
    plain = {"doc_id": F.col("doc_id"), "pos": F.col("pos"), "rare": F.col("rare"), "common": F.col("common"), "size": size, "before": before, "between": between}
    cells = cells.select(F.xxhash64("tok", "next").alias("key"), *(F.coalesce(c, zero).alias(x) for x, c in plain.items()))
    a, b = cells.alias("a"), cells.alias("b")
    na, nb = (F.shiftright(f"{x}.size", 32) for x in "ab")
    ia, ib = (F.shiftright(f"{x}.size", 1).bitwiseAND(F.lit((1 << 31) - 1)) for x in "ab")
    most = F.least(ia, ib) + F.least(na - ia, nb - ib)  # i tokens lie up to and with the shared one
    on = (F.col("a.key") == F.col("b.key")) & ((F.col("a.size") % 2) * F.col("b.size") > 0) & _alike(na, nb, percent, most)
    # lines that share the token before as well meet by that one; so a pair shows up a few times, not once a shared key
    for c in ("before", "between"):
        on = on & ((F.col(f"a.{c}") != F.col(f"b.{c}")) | (F.col(f"a.{c}") == 0))
    return a.join(b, on).select(*_pair()).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Distinct later lines (doc_id, pos) of saved ``pairs`` whose sets reach the limit. Only lines of these pairs are fetched."""
    ends = pairs.select("doc_id", "pos").unionByName(pairs.select(F.col("doc_b").alias("doc_id"), F.col("pos_b").alias("pos")))
    wanted = ends.groupBy("doc_id", F.shiftright("pos", PLACE).alias("nth")).agg(F.collect_set(_place(F.col("pos"))).alias("places"))  # at most the lines of one document
    # the texts meet their places by a shuffle at every size: what is wanted grows with the corpus
    text = docs.join(wanted.hint("shuffle_hash"), ["doc_id", "nth"])
    lines = F.arrays_zip(F.col("places").alias("at"), _picked(F.split(_spaced(F.col("text")), "\n"), F.col("places")).alias("line"))
    found = text.select("doc_id", "nth", F.explode(lines).alias("l")).select("doc_id", _pos(F.col("nth"), F.col("l.at")).alias("pos"), "l.line")
    sets = saved(found.select("doc_id", "pos", _words(F.col("line")).alias("s")), "linesets")
    first = pairs.join(sets.withColumnRenamed("s", "s_a"), ["doc_id", "pos"])
    both = first.join(sets.select(F.col("doc_id").alias("doc_b"), F.col("pos").alias("pos_b"), F.col("s").alias("s_b")), ["doc_b", "pos_b"])
    common = F.size(F.array_intersect("s_a", "s_b"))
    found = saved(both.where(common * 100 >= (F.size("s_a") + F.size("s_b") - common) * percent).select("doc_id", "pos").distinct(), "matched")
    drop(sets)
    return found


def repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Lines ``(doc_id, nth, pos)`` that an earlier line matches: Jaccard of their word sets of at least ``percent``/100.

    Earlier is by document id (whole numbers; null after all others), for several texts of one id by their hash, then by place in the text; ``nth`` numbers
    these texts from 0. Lines of equal sets fall to the first of them at once. For the others the
    set-similarity join orders tokens by rarity (counts over all texts in a table of fixed size, ties by hash) and
    joins prefixes under length, positional and parity filters, which lose no match. A line needs only one match: first it
    meets the earliest lines that share two of its rarest tokens, and only those that this leaves unmatched meet all others.
    ``percent`` lies above 50, where two different sets that reach it share two words at least.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    found = _repeated(_numbered(docs.select("doc_id", "text"), "doc", "nth")[1], percent)
    return found.select(F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id"), F.shiftright("pos", PLACE).alias("nth"), _place(F.col("pos")).alias("pos"))


def _repeated(one: DataFrame, percent: int) -> DataFrame:
    """Repeated lines ``(doc_id, pos)`` of numbered documents."""
    rows = saved(_lines(one, *_levels(one), percent), "lines")
    # in two steps: of one document's lines the first counts
    each = rows.groupBy("f1", "f2", "doc_id").agg(F.min("pos").alias("pos"), F.count("*").alias("size"))
    classes = each.groupBy("f1", "f2").agg(F.min("doc_id").alias("doc_1"), F.min_by("pos", "doc_id").alias("pos_1"), F.sum("size").alias("size")).where("size > 1")
    firsts = saved(classes.drop("size"), "firsts")
    found = rows.join(firsts.hint("shuffle_hash"), ["f1", "f2"], "left")
    found = found.withColumn("copy", F.col("doc_1").isNotNull() & ((F.col("doc_id") != F.col("doc_1")) | (F.col("pos") != F.col("pos_1"))))
    told = saved(found.select("doc_id", "pos", "n", "rare", "common", F.when(~F.col("copy"), F.col("prefix")).alias("prefix"), "copy"), "sets")
    drop(rows, firsts)
    sets, copies = told.where("not copy").drop("copy"), told.where("copy").select("doc_id", "pos")
    near = saved(_firsts(sets, percent), "near")
    done = _verified(near, one, percent)
    settled = done.withColumn("open", F.lit(0))
    left = saved(sets.join(settled.hint("shuffle_hash"), ["doc_id", "pos"], "left").withColumn("open", F.coalesce("open", F.lit(1))), "open")
    copies = saved(copies, "copies")
    drop(near, told)
    rounds = _rounds(left)
    found = [saved(_candidates(left, percent, part, rounds), "pairs") for part in range(rounds)]
    drop(left)
    pairs = found[0]
    if rounds > 1:  # a pair may share keys of several rounds
        pairs = saved(reduce(DataFrame.unionByName, found).distinct(), "pairs")
        drop(*found)
    later = _verified(pairs, one, percent)
    drop(pairs)
    removed = saved(copies.unionByName(done).unionByName(later), "removed")  # each line once: copies are no firsts, later ones were open
    drop(copies, done, later)
    return removed


def line_dedup(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The input rows with repeated lines taken out of ``text``, and beside it ``n_lines`` (with words), ``n_removed`` and ``removed`` (their places).

    Lines without words never match and stay; a null text stays null with no lines. Ids are whole numbers or null. Rows that repeat an id with the same text
    count as one document: they match only what stands earlier, not each other. Different texts of one id are documents of their own, one after the other by
    their hash, as are those of null ids, which come after all others. Other columns pass through, those named like the new ones are
    replaced; an empty table gives no rows.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    doc, nth, gone = (f"{x}_{uuid.uuid4().hex}" for x in ("doc", "nth", "gone"))  # names that no column of the input has
    numbered, one = _numbered(docs.drop("n_lines", "n_removed", "removed"), doc, nth)
    found = _repeated(one, percent)
    lost = found.groupBy(F.col("doc_id").alias(doc), F.shiftright("pos", PLACE).alias(nth)).agg(F.array_sort(F.collect_set(_place(F.col("pos")))).alias(gone))
    counted = F.size(F.filter(F.split(F.col("text").cast("string"), "\n"), lambda x: F.ltrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    # a null text has no lines: so nothing else asks for the text, and callers that drop it don't have it shuffled
    joined = numbered.withColumn("n_lines", F.coalesce(counted, F.lit(-1)).cast("long")).join(lost.hint("shuffle_hash"), [doc, nth], "left")
    joined = joined.withColumn(gone, F.when(F.col("n_lines") >= 0, F.col(gone))).withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long")))
    lines = F.split(F.col("text").cast("string"), "\n")
    left = F.transform(F.array(lines), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone)), lambda i: F.get(x, i)))[0]
    return joined.withColumns(
        {
            "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
            "removed": F.coalesce(F.col(gone), F.array().cast("array<int>")),
            "text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n")),
        }
    ).drop(doc, nth, gone)
