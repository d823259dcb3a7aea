"""SpotSigs document fingerprints.

A spot signature is an anchor (a very common word) with the chain of the next
``CHAIN`` content words after it, common words skipped.  A text's fingerprint
is the set of its signatures; two texts are as alike as the Jaccard
coefficient of their sets.  Near-duplicate pairs are found among sets of
similar length only: sets are partitioned by length, and a pair whose lengths
alone keep the coefficient below the threshold is never compared.

DataFrame and SQL functions only.  Words are the runs of letters and digits
of the lower-cased text.  A text without any signature has one made of all
its words, so that equal texts have equal fingerprints and others do not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from socialpages.llm.common import fresh, shuffle_partitions
from socialpages.llm.components import components
from socialpages.plans.lineage import discard, staged

CHAIN = 2
# Common words of four languages, the anchors.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das den der des die ein eine für ist mit nicht und von zu "
    "au avec ce dans de des du en est et la le les par pas pour que qui un une "
    "con del el los no para por se su una y"
)
PARTS_PER_TASK = 4
BLOCK = 1024
PARTS_PER_HASH = 0.7
HOT_SAMPLE, HOT_LEAST, HOT_LIST = 4096, 8, 1024


def signatures(text: Column | str, anchors: str = ANCHORS, chain: int = CHAIN) -> Column:
    """The sorted distinct signature hashes of a text (null: as empty)."""
    text = F.col(text) if isinstance(text, str) else text
    listed = "|".join(sorted(set(anchors.split()), key=lambda w: (-len(w), w)))
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    # an anchor is tied to the word after it by "\u0001", so that a token is a
    # content word with the anchors just before it
    tied = F.regexp_replace(plain, rf"(?<![^ ])({listed}) ", "$1\u0001")

    def of(r: Column) -> Column:
        tokens = r["tokens"]
        content = r["content"]

        def at(token: Column, i: Column) -> Column:
            words = [F.get(content, i + j) for j in range(chain)]
            own = F.split(token, "\u0001")
            complete = words[-1].isNotNull()
            return F.when(
                complete & (F.instr(token, "\u0001") > 0),
                F.transform(F.slice(own, 1, F.size(own) - 1), lambda a: F.xxhash64(a, *words)),
            ).otherwise(F.array().cast("array<bigint>"))

        return F.flatten(F.transform(tokens, at))

    # each step is bound by a one-element transform, so that no lambda
    # computes an outer array again for each of its elements
    bound = F.transform(F.array(tied), lambda s: F.split(s, " "))
    bound = F.transform(
        bound,
        lambda t: F.struct(t.alias("tokens"), F.transform(t, lambda w: F.substring_index(w, "\u0001", -1)).alias("content")),
    )
    # a last token that ends in an anchor is anchors only and goes
    known = F.array(*map(F.lit, sorted(set(anchors.split()))))

    def closed(r: Column) -> Column:
        n = F.size(r["tokens"])
        kept = n - F.when(F.array_contains(known, F.get(r["content"], n - 1)), 1).otherwise(0)
        return F.struct(F.slice(r["tokens"], 1, kept).alias("tokens"), F.slice(r["content"], 1, kept).alias("content"))

    bound = F.transform(bound, closed)
    found = F.get(F.transform(bound, of), 0)
    found = F.sort_array(F.array_distinct(found))
    return F.get(
        F.transform(
            F.array(F.struct(found.alias("s"), plain.alias("p"))),
            lambda r: F.when(F.size(r["s"]) > 0, r["s"]).otherwise(F.array(F.xxhash64(r["p"], F.lit("all")))),
        ),
        0,
    )


def digest(signature_set: Column | str) -> Column:
    """The fingerprint string of a signature set."""
    s = F.col(signature_set) if isinstance(signature_set, str) else signature_set
    return F.md5(F.concat_ws(",", F.transform(s, lambda x: F.hex(x))))


def likeness(a: Column | str, b: Column | str, at_least: float = 0.0) -> Column:
    """Jaccard coefficient of two signature sets (null if either is).  If the
    lengths alone keep it below ``at_least``, it is not computed and 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))

    def jaccard(r: Column) -> Column:
        return r["i"] / (F.size(r["a"]) + F.size(r["b"]) - r["i"])

    pair = F.transform(
        F.array(F.struct(a.alias("a"), b.alias("b"))),
        lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), F.size(F.array_intersect(r["a"], r["b"])).alias("i")),
    )
    exact = F.get(F.transform(pair, jaccard), 0)
    if not at_least:
        return exact
    return F.when(F.least(F.size(a), F.size(b)) < at_least * F.greatest(F.size(a), F.size(b)), F.lit(0.0)).otherwise(exact)


def _id_range(docs: DataFrame, id_column: str, parts: int) -> Column:
    """Number of the range that a row's id falls in (null: the lowest); the
    ranges hold about as many rows each and follow the ids' order."""
    at = [i / parts for i in range(1, parts)]
    ids = docs.select(F.col(id_column).cast("double").alias("id"))
    bounds = sorted({math.floor(b) for b in ids.approxQuantile("id", at, 0.2 / parts)}) if at else []
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    # binary search: how many bounds are at or below the id
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.get(held, low + step - 1) <= F.col(id_column)), low + step
        ).otherwise(low),
    )


def with_next(
    docs: DataFrame, columns: dict[str, Column], id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the given computed columns, and for each of them
    ``next_<name>``: its value in the next row by descending id (after the
    last row: the first).  Null ids come last; rows of one id are ordered by
    their text.

    The rows are dealt into ranges of ids, so that no task holds them all; the
    first row of each range is also sent to the range before it.
    """
    spark = docs.sparkSession
    parts = PARTS_PER_TASK * shuffle_partitions(spark)
    part, lent, tie = (fresh(docs, c) for c in ("_part", "_lent", "_tie"))
    placed = docs.withColumn(part, _id_range(docs, id_column, parts)).withColumn(lent, F.lit(False))
    # one row for each range: bounded by the number of ranges
    tops = {r[part]: r["top"] for r in placed.groupBy(part).agg(F.max(id_column).alias("top")).collect()}
    if not tops:
        loans = []
    else:
        filled = sorted(tops)
        loans = [(tops[filled[i - 1]], filled[i]) for i in range(1, len(filled))] + [(tops[filled[-1]], filled[0])]
    to, top = fresh(docs, "_to"), fresh(docs, "_top")
    loans = spark.createDataFrame(loans, f"{top} long, {to} int")
    borrowed = docs.join(F.broadcast(loans), F.col(id_column).cast("long").eqNullSafe(F.col(top)))
    borrowed = borrowed.select(*docs.columns, F.col(to).alias(part), F.lit(True).alias(lent))
    rows = placed.unionByName(borrowed).repartition(shuffle_partitions(spark), part)
    rows = rows.withColumn(tie, F.xxhash64(text)).withColumns(columns)
    by = Window.partitionBy(part).orderBy(
        lent, F.col(id_column).desc_nulls_last(), F.col(tie).desc(), F.col(text).desc_nulls_last()
    )
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(by) for c in columns})
    return rows.where(~F.col(lent)).drop(part, lent, tie)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "signatures", **options) -> DataFrame:
    """``docs`` with its signature set as a sorted array<bigint> column ``out`` (with
    underscores in front where ``docs`` has that name).  A null text counts as empty.  Every row stays; other columns are carried along."""
    return docs.withColumn(fresh(docs, out), signatures(text, **options))


def _rare_first(sets: DataFrame) -> DataFrame:
    """``sets(print, set)`` with the hashes of each set in the order of
    how many sets hold them, rarest first, and ``n``, the set's size."""
    each = sets.select("print", F.size("set").alias("n"), F.explode("set").alias("sig"))
    each = each.join(each.groupBy("sig").agg(F.count(F.lit(1)).alias("held")), "sig")
    ranked = each.groupBy("print", "n").agg(F.sort_array(F.collect_list(F.struct("held", "sig"))).alias("ranked"))
    return ranked.select("print", "n", F.col("ranked.sig").alias("set"))


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``(print, n, band, pos, sig)``: the hashes, with their place, of which
    two sets as alike as ``threshold`` share the first one that they share."""
    band = F.floor(F.log("n") / F.lit(math.log(1 / threshold))).cast("int")
    prefix = F.slice("set", 1, (F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1).cast("int"))
    return sets.select("print", "n", band.alias("band"), F.posexplode(prefix).alias("pos", "sig"))


def _likely(member: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Pairs ``(a, b)`` of different roots that meet in a bucket of
    ``member(print, n, band, pos, sig, near, root)`` and pass the length and
    position bounds.  A bucket is cut into blocks, and each pair of blocks is
    joined by a key of its own."""
    size = member.groupBy("band", "sig").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"))
    size = size.where("low <> high").selectExpr("band", "sig", f"cast(ceil(rows / {block}) as int) as blocks")
    member = member.join(size, ["band", "sig"]).withColumn("mine", F.expr("cast(pmod(xxhash64(print), blocks) as int)"))
    others = F.explode(F.expr("sequence(0, blocks - 1)"))
    a = member.withColumn("other", others).withColumnsRenamed({"mine": "i", "other": "j"})
    b = member.where("near = 0").withColumn("other", others).withColumnsRenamed({"other": "i", "mine": "j"})
    pair = a.alias("a").join(b.alias("b"), ["band", "sig", "i", "j"])
    pair = pair.where("a.root <> b.root and a.n <= b.n").where(F.col("a.n") >= F.lit(threshold) * F.col("b.n") - 1e-9)
    # at the first hash that a pair shares, what is left of both holds all that they share
    shared = F.lit(threshold / (1 + threshold)) * (F.col("a.n") + F.col("b.n")) - 1e-9
    pair = pair.where(F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= shared)
    return pair.select(F.col("a.print").alias("a"), F.col("b.print").alias("b"))


def _hot(rows: DataFrame, sample: int = HOT_SAMPLE) -> list[int]:
    """The hashes (at most ``HOT_LIST``) that at least ``HOT_LEAST`` of about ``sample`` sets of
    ``rows(print, set)`` hold, picked by their fingerprints.  They decide the order of
    comparison only, never whether a pair is found."""
    every = max(1, rows.count() // sample)
    picked = rows.where(F.pmod(F.xxhash64("print"), F.lit(every)) == 0).groupBy("print").agg(F.first("set").alias("set"))
    held = picked.select(F.explode("set").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
    most = held.where(F.col("held") >= HOT_LEAST).orderBy(F.desc("held"), "sig").limit(HOT_LIST)
    return [r["sig"] for r in most.collect()]


def _segments(rows: DataFrame, threshold: float, hot: list[int]) -> DataFrame:
    """``(print, n, band, near, sure, sigs)``: hashes of parts of each set of ``rows(print, set)``, of which
    two sets as alike as ``threshold`` share one, if one of them is ``sure``.

    The range of the hashes is cut into parts of equal width, their number fixed by the
    band of lengths.  What two sets differ in touches at most as many parts as it has
    hashes, ``most``; all other parts are equal.  So the first part in any
    common order that both hold alike is among the first ``most + 1`` of both.  The order is by
    size, largest first: parts of several hashes, that only related texts have in common.  Hot hashes
    are left out of the parts.  A set of no more than ``most`` parts has no part to be sure of.

    A set is cut by its own band (``near`` 0) and, if it has longer partners there, by the next (1)."""
    ratio = 3 * math.log(1 / threshold)

    def band(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(ratio)).cast("int")

    def parts(r: Column) -> Column:
        held, level, count = r["cool"], r["band"], r["count"]
        # the hashes are sorted, so that each part is a run of them
        numbers = F.transform(held, lambda h: F.shiftright((F.shiftright(h, 32) + F.lit(1 << 31)) * count, 32))
        places = F.when(F.size(held) > 0, F.sequence(F.lit(0), F.size(held) - 1)).otherwise(F.array().cast("array<int>"))
        cut = F.transform(F.array(numbers), lambda x: F.filter(places, lambda i: (i == 0) | (F.get(x, i) != F.get(x, i - 1))))

        def runs(starts: Column) -> Column:
            def run(at: Column, i: Column) -> Column:
                long = F.coalesce(F.get(starts, i + 1), F.size(held)) - at
                return F.struct((-long).alias("size"), F.xxhash64(level, F.slice(held, at + 1, long)).alias("sig"))

            return F.sort_array(F.transform(starts, run))

        return F.get(F.transform(cut, runs), 0)

    n = F.size("set")
    last = F.floor(n / F.lit(threshold) + 1e-9)
    cool = F.array_except("set", F.lit(hot).cast("array<bigint>")) if hot else F.col("set")
    bands = F.array(F.struct(band(n).alias("band"), F.lit(0).alias("near")), F.struct((band(n) + 1).alias("band"), F.lit(1).alias("near")))
    bands = F.slice(bands, 1, F.when(band(last) > band(n), 2).otherwise(1))
    most = F.floor(n * F.lit((1 - threshold) / threshold) + 1e-9).cast("int")
    count = F.ceil(F.lit(PARTS_PER_HASH) * F.exp(F.col("at.band") * F.lit(ratio))).cast("long")
    cuts = rows.select("print", n.alias("n"), most.alias("most"), cool.alias("cool"), bands.alias("bands"))
    cuts = cuts.select("print", "n", "most", "cool", F.explode("bands").alias("at"))
    cuts = cuts.select("print", "n", "most", "at.*", F.transform(F.array(F.struct("cool", "at.band", count.alias("count"))), parts)[0]["sig"].alias("sigs"))
    sure = (F.size("sigs") > F.col("most")).alias("sure")
    return cuts.select("print", "n", "band", "near", sure, F.slice("sigs", 1, F.col("most") + 1).alias("sigs"))


def _not_alone(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """The sets of ``rows(print, set)``, each once, that can be near another one (and some
    more): those with a part, of ``cuts`` of all of them, that another set holds too, and those
    that are not sure of their parts.  Only hashes of parts are moved to find them.  Two sets
    count as one there if 64 bits of their fingerprints agree."""
    mark = F.xxhash64("print").alias("mark")
    parts = cuts.select(mark, F.explode("sigs").alias("sig"))
    shared = parts.groupBy("sig").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where("low <> high").select("sig")
    found = parts.join(shared, "sig", "left_semi").select("mark").unionByName(cuts.where("not sure").select(mark))
    found = rows.withColumn("mark", mark).join(found.distinct(), "mark", "left_semi")
    return found.groupBy("print").agg(F.first("set").alias("set"))


def _buckets(sets: DataFrame, cuts: DataFrame, threshold: float) -> DataFrame:
    """``(print, n, band, pos, sig, near, least)``: the buckets of more than one set, with their
    least, in which two sets of ``sets(print, set)`` as alike as ``threshold`` meet: those of the parts
    (``cuts`` of the same sets), and of the prefixes of the sets that are not sure of
    their parts, rarest first over these."""
    parts = cuts.select("print", "n", "band", F.lit(0).alias("pos"), F.explode("sigs").alias("sig"), "near")
    unsure = cuts.where("not sure").select("print").distinct()
    index = _prefixes(_rare_first(sets.join(unsure, "print", "left_semi")), threshold)
    # a set is in the buckets of its band and, for longer partners, of the next
    reach = index.withColumn("near", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.col("band") + F.col("near"))
    reach = parts.unionByName(reach)
    least = reach.groupBy("band", "sig").agg(F.min("print").alias("least"), F.max("print").alias("most")).where("least <> most")
    return reach.join(least.drop("most"), ["band", "sig"])


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.8, **options
) -> DataFrame:
    """``(id, fingerprint, class_id)`` of every row: texts whose sets have a
    Jaccard coefficient of at least ``threshold`` are linked, and ``class_id``
    is the least id reachable.

    Equal sets count once.  Sets that share no part with another one (``_segments``) are classes
    of their own and go no further.  The others are partitioned by length into bands so wide
    that likely pairs are in one band or in neighbouring ones; within a band a pair must share
    one of the first parts of both or, where neither has enough parts, one of the
    first hashes of both, the rarest over all these sets coming first (prefix filter:
    a hash that many sets hold is in the prefix of few), then pass the length
    and position bounds, then the exact coefficient.

    First each set is compared to the least set of each of its buckets, which
    is linear and joins most of a large group of near copies.  Then only pairs
    from different components are left to compare, in the buckets that hold
    more than one, block by block.  Ids are of any type with an order.  A null id
    never names a class; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), signatures(text, **options).alias("set"))
    rows, held = staged(rows.withColumn("print", F.unhex(digest("set"))))
    firsts, _ = staged(rows.groupBy("print").agg(F.min("doc_id").alias("first")))
    hot = _hot(rows)
    cuts, cut = staged(_segments(rows, threshold, hot))
    sets, between = staged(_not_alone(rows.select("print", "set"), cuts))
    discard(spark, cut)
    cuts, cut = staged(_segments(sets, threshold, hot))
    reach, order = staged(_buckets(sets, cuts, threshold))

    def verified(likely: DataFrame) -> DataFrame:
        x = sets.select(F.col("print").alias("a"), F.col("set").alias("sa"))
        y = sets.select(F.col("print").alias("b"), F.col("set").alias("sb"))
        near = likely.distinct().join(x, "a").join(y, "b")
        return near.where(likeness("sa", "sb", threshold) >= threshold).select("a", "b")

    def with_roots(prints: DataFrame, links: DataFrame) -> DataFrame:
        found = components(links).withColumnRenamed("node", "print")
        return staged(prints.select("print").join(found, "print", "left").select("print", F.coalesce("root", "print").alias("root")))[0]

    stars, _ = staged(verified(reach.where("least <> print").select(F.col("least").alias("a"), F.col("print").alias("b"))))
    member = reach.drop("least").join(with_roots(sets, stars), "print")
    rest, _ = staged(verified(_likely(member, threshold)))
    rooted = firsts.join(with_roots(firsts, stars.unionByName(rest)), "print")
    label = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("class_id")), "root").select("print", "class_id")
    label, _ = staged(label)
    prints, _ = staged(rows.select("doc_id", "print"))
    for path in (held, between, cut, order):
        discard(spark, path)
    return prints.join(label, "print").select(
        F.col("doc_id").alias(id_column), F.lower(F.hex("print")).alias("fingerprint"), "class_id"
    )


def edited(text: str, following: str) -> Column:
    """A text whose last half (rounded down) is replaced by as many characters
    from the start of the following text, or all it has."""
    n = F.char_length(F.col(text))
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - half), F.substring(F.col(following), F.lit(1), half))


def edit_check(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_signatures).  Null texts count as empty.  Ids are
    integers (rows are dealt out by ranges of them); null ids come last, rows of
    one id are ordered by their text.  An empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows, {"body": F.col("text"), "set": signatures("text")})
    rows = rows.withColumn("edited", edited("text", "next_body")).withColumn("edited_set", signatures("edited"))
    return rows.select(
        F.col("doc_id").alias(id_column),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digest("set").alias("fingerprint"),
        digest("edited_set").alias("edited_fingerprint"),
        likeness("set", "edited_set").alias("near_edited"),
        likeness("set", "next_set").alias("near_next"),
        F.size("set").cast("long").alias("n_signatures"),
    )
