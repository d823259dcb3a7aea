"""Quotation linking: quoted passages joined to their original messages, and
conversations in reply order without the quotes.

A line's quote level is the number of ">" it starts with (a space may follow
each).  A passage is a run of lines of one level without a blank line; its
hash is taken over its lower-cased text with white space collapsed.  The
original of a quoted passage is the least message (by id) that has it as a
passage of its own, at level 0, if that message is less than the quoting one.
A message replies to the original of its passages of the lowest level that
has any: the one with most of them, of equals the least.

Own passages are reduced to one row per hash before the join, so a passage
that a third of all messages quote meets one row, and the quoting messages of
such a passage are dealt over many partitions.  Roots are found by pointer
doubling, a join each round over the messages that are not there yet; the
answers to one much-answered message are dealt out alike.
DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialpages.llm.common import fresh, join_to_unique
from socialpages.plans.lineage import discard, staged

# possessive: the greedy form would recurse for every mark
_MARK = "^(?:> ?)*+"
_SPACE = "[\\\\x20\\\\x09-\\\\x0D]+"


def _lines_sql(text: str) -> str:
    """Array of (d: quote level, b: the line without its marks)."""
    return (
        f"transform(split(coalesce({text}, ''), '\\n', -1), l -> named_struct("
        f"'d', length(translate(regexp_extract(l, '{_MARK}', 0), ' ', '')), 'b', regexp_replace(l, '{_MARK}', '')))"
    )


def normal_sql(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '{_SPACE}', ' '))"


def parsed(messages: DataFrame, text: str = "text", own: str = "own_text", passages: str = "passages") -> DataFrame:
    """``messages`` with ``own``, the text without quoted lines, and
    ``passages``, an array of (level, hash) of its passages with any word.
    A null text counts as empty."""
    # a line continues its passage if the line before has its level and
    # neither is blank; "\u0001" starts a passage, "\u0002" ends its level (in a
    # passage the two count as spaces; the own text keeps them)
    runs = (
        "array_join(transform(ls, (p, i) -> concat("
        "if(i > 0 and ls[greatest(i - 1, 0)].d = p.d and trim(p.b) <> '' and trim(ls[greatest(i - 1, 0)].b) <> '', "
        "'\\n', concat('\\u0001', p.d, '\\u0002')), translate(p.b, '\\u0001\\u0002', '  '))), '')"
    )
    cut = f"filter(split(({runs}), '\\u0001', -1), x -> x <> '')"
    shaped = (
        f"filter(transform({cut}, x -> named_struct('level', cast(substring_index(x, '\\u0002', 1) as int), "
        f"'body', {normal_sql("substring_index(x, '\\u0002', -1)")})), x -> x.body <> '')"
    )
    hashed = f"transform({shaped}, x -> named_struct('level', x.level, 'hash', unhex(md5(x.body))))"
    kept = "array_join(transform(filter(ls, p -> p.d = 0), p -> p.b), '\\n')"
    both = f"transform(array({_lines_sql(text)}), ls -> named_struct('own', {kept}, 'passages', {hashed}))[0]"
    held = fresh(messages, "_parsed")
    return (
        messages.withColumn(held, F.expr(both))
        .withColumn(own, F.col(f"{held}.own"))
        .withColumn(passages, F.col(f"{held}.passages"))
        .drop(held)
    )


def links(rows: DataFrame) -> DataFrame:
    """(id, parent, n_quoted, n_linked) of the quoting messages in
    ``rows(id, passages)``."""
    units = rows.select("id", F.explode("passages").alias("p")).select("id", "p.level", "p.hash")
    first = units.where("level = 0").groupBy("hash").agg(F.min("id").alias("original"))
    first, _ = staged(first)
    found = join_to_unique(units.where("level > 0"), first, "hash", "id", "left")
    found = found.withColumn("original", F.when(F.col("original") < F.col("id"), F.col("original")))
    voted = found.groupBy("id", "level", "original").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("original").isNotNull(), F.struct("level", (-F.col("n")).alias("n"), "original")))
    return voted.groupBy("id").agg(
        best["original"].alias("parent"),
        F.sum("n").alias("n_quoted"),
        F.sum(F.when(F.col("original").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"),
    )


def roots(parents: DataFrame) -> DataFrame:
    """(id, root, level) from ``parents(id, parent)`` with distinct ids.  A
    message without a parent is its own root at level 0.  A parent is less
    than its message, so there is no cycle."""
    spark = parents.sparkSession
    top = F.col("parent").isNull()
    state, path = staged(
        parents.select(
            "id", F.when(top, F.col("id")).otherwise(F.col("parent")).alias("at"), F.when(top, 0).otherwise(1).alias("level"), top.alias("done")
        )
    )
    while state.where("not done").take(1):
        ahead = state.select(F.col("id").alias("at"), F.col("at").alias("next"), F.col("level").alias("more"), F.col("done").alias("last"))
        moved = join_to_unique(state.where("not done"), ahead, "at", "id").select(
            "id", F.col("next").alias("at"), (F.col("level") + F.col("more")).alias("level"), F.col("last").alias("done")
        )
        new, written = staged(state.where("done").unionByName(moved))
        discard(spark, path)
        state, path = new, written
    return state.select("id", F.col("at").alias("root"), "level")


def conversations(messages: DataFrame, id_column: str = "id", text: str = "text", out: str = "thread") -> DataFrame:
    """``messages`` with a struct column ``out`` (with underscores in front where ``messages``
    has that name): ``own_text`` (without quotes),
    ``parent``, ``root`` (the conversation), ``level`` (replies below the root),
    ``n_quoted`` and ``n_linked`` (quoted passages, and those with an original).
    Sorted by root, level and id, a conversation reads in order of reply.

    Ids are of any type with an order, by which earlier messages are less; rows
    of one id are one message.  A row with a null id (a struct with null fields
    is none) is linked to nothing.  A null or empty text has no passages.  Every row stays, repeated ones too; an empty table gives no
    rows; other columns are carried along.
    """
    out = fresh(messages, out)
    own, passages = fresh(messages, "_own"), fresh(messages, "_passages")
    rows = parsed(messages, text, own, passages)
    # ids and hashes only; the texts are parsed again where they are returned
    keyed, held = staged(rows.select(F.col(id_column).alias("id"), F.col(passages).alias("passages")).where("id is not null"))
    found, between = staged(links(keyed))
    tree = roots(keyed.select("id").distinct().join(found.select("id", "parent"), "id", "left"))
    thread, _ = staged(tree.join(found, "id", "left"))
    for path in (held, between):
        discard(messages.sparkSession, path)
    names = {c: fresh(messages, f"_t_{c}") for c in thread.columns}
    thread = thread.toDF(*names.values())
    joined = rows.join(thread, rows[id_column] == thread[names["id"]], "left")
    struct = F.struct(
        F.col(own).alias("own_text"),
        F.col(names["parent"]).alias("parent"),
        F.col(names["root"]).alias("root"),
        F.coalesce(names["level"], F.lit(0)).alias("level"),
        F.coalesce(names["n_quoted"], F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce(names["n_linked"], F.lit(0)).cast("long").alias("n_linked"),
    )
    return joined.withColumn(out, struct).select(*messages.columns, out)


def quoted(text: str, times: int = 1) -> Column:
    """Every line of a text behind ``times`` quote marks."""
    mark = "> " * times
    return F.expr(f"concat('{mark}', replace({text}, '\\n', '\\n{mark}'))")


def as_replies(turns: DataFrame) -> DataFrame:
    """A table of conversation turns (conv_id, turn, role, text) as messages
    that quote what they answer, as mail programs write them: the turn before
    behind one mark, the one before that behind two.  Adds ``id`` (the struct of
    conv_id and turn) and ``message``.  Turns are matched by (conv_id, turn), a
    key of a few rows, so a long conversation is spread; of rows with one key
    the least text is quoted.  Turns with a null conv_id or turn quote nothing.
    """
    said = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said")).where("said is not null")
    back = [said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("said").alias(f"said_{n}")) for n in (1, 2)]
    rows = turns.join(back[0], ["conv_id", "turn"], "left").join(back[1], ["conv_id", "turn"], "left")
    parts = F.array_compact(F.array(quoted("said_2", 2), quoted("said_1", 1), F.coalesce("text", F.lit(""))))
    return rows.select(
        *turns.columns, F.struct("conv_id", "turn").alias("id"), F.array_join(parts, "\n").alias("message")
    )
