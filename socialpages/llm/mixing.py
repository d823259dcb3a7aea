"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed over the cells source x language x topic, which is the only
pass over the rows before sampling; everything iterative runs on the cells.
Raking scales the cells to each dimension's target shares in turn until no
factor moves.  A row is then kept with a probability in proportion to its
cell's factor.  If the largest probability being 1 gives the token budget or
more, the expected tokens kept have the target marginals.  Otherwise the scale
is solved for the budget: cells whose factor would ask for more than all their
tokens are kept whole (and fall short of their target by what they lack), the
others stay in proportion, so that a rare cell does not set the sample's size.
DataFrame functions only.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialpages.llm.common import WORD_PATTERN, fresh
from socialpages.plans.lineage import discard, staged

DIMENSIONS = ("source", "lang", "topic")
MAX_SWEEPS = 50
TOLERANCE = 1e-9
SEED = 7
# Fixed value: the least share of all tokens that a sample is expected to hold.
BUDGET = 0.3
# A raked share that is farther from its target than this is reported.
MAX_MISS = 1e-3
LONG_WORDS = 1000
SHORT_WORDS = 50


def n_tokens(text: str = "text") -> Column:
    """Words of a text as its token weight (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def topic(text: str = "text", tokens: str = "n_tokens") -> Column:
    """A coarse topic by fixed signs: licence notices, contact data, then length."""
    t = F.coalesce(F.col(text), F.lit(""))
    any_of = lambda *signs: F.greatest(*[F.contains(t, F.lit(s)) for s in signs])
    return (
        F.when(any_of("icensed under", "eleased under", "ights reserved"), "licensed")
        .when(any_of("@", "://"), "contact")
        .when(F.col(tokens) >= LONG_WORDS, "long")
        .when(F.col(tokens) < SHORT_WORDS, "short")
        .otherwise("prose")
    )


def _key(name: str) -> Column:
    """A null is a category of its own, apart from any text."""
    c = F.col(name).cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("+"), c))


def _shares(cells: DataFrame, dimension: str, target) -> DataFrame:
    """(dimension, share) adding up to 1 over the categories with tokens.

    ``target`` is a power (share of tokens to that power: 1 keeps the shares,
    0 makes them equal) or a dict from category to weight; a category that
    the dict lacks weighs its present share.
    """
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    whole = cells.agg(F.sum("tokens").cast("double")).scalar()
    share = F.col("t") / whole
    if isinstance(target, dict):
        weight = share
        for category, w in target.items():
            weight = F.when(F.col(dimension) == ("-" if category is None else f"+{category}"), F.lit(float(w))).otherwise(weight)
    else:
        weight = F.pow(share, F.lit(float(target)))
    weights = sums.select(dimension, weight.alias("weight"))
    total = weights.agg(F.coalesce(F.nullif(F.sum("weight"), F.lit(0.0)), F.lit(1.0))).scalar()
    return weights.select(dimension, (F.col("weight") / total).alias("share"))


def _step(state: DataFrame, dimension: str, share: str) -> DataFrame:
    """``state`` with its factors scaled to the target shares of one dimension.  The
    cells are read twice, and the scales are the only other side of a join."""
    got = state.groupBy(dimension).agg(F.sum(F.col("factor") * F.col("tokens")).alias("got"), F.max(share).alias("share"))
    scale = got.where("got > 0 and share is not null").select(dimension, (F.col("share") / F.col("got")).alias("scale"))
    scaled = state.join(scale, dimension, "left")
    return scaled.withColumn("factor", F.col("factor") * F.coalesce("scale", F.lit(1.0))).select(*state.columns)


def rake(
    cells: DataFrame, targets: dict, max_sweeps: int = MAX_SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``cells`` (the dimensions' columns, ``tokens``) with ``factor``: raked
    weight over tokens, up to scale; a table in the shared folder.

    The targets' names are the dimensions.  Stops when no factor moves by more
    than ``tolerance`` (relative) in a sweep, or after ``max_sweeps``.  Cells
    without tokens take the factors of their categories (a category without
    any tokens: 1).
    """
    return _raked(cells, targets, max_sweeps, tolerance)[0]


def _raked(
    cells: DataFrame, targets: dict, max_sweeps: int = MAX_SWEEPS, tolerance: float = TOLERANCE
) -> tuple[DataFrame, float]:
    """The raked cells and the largest difference of a share from its target."""
    names = list(targets)
    state, path = staged(cells.select(*names, "tokens", F.lit(1.0).alias("factor")))
    share_of = {d: fresh(state, f"_share_{d}") for d in names}
    # every cell carries its targets, so that the steps need no other table
    state, path = _restaged(_with_shares(state, targets, share_of), path)
    for _ in range(max_sweeps):
        state = state.withColumn("before", F.col("factor"))
        # a step is a table of its own: the plan of a whole sweep would hold the
        # first step's twice in the second and four times in the third
        for d in names:
            state, path = _restaged(_step(state, d, share_of[d]), path)
        # the first sweep sets the scale, so it always moves
        moved = state.agg(F.max(F.abs(F.ln(F.col("factor") / F.col("before"))))).first()[0]
        if moved is None or moved <= tolerance:
            break
    return state.select(*names, "tokens", "factor"), _miss(state, share_of)


def _restaged(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """``df`` staged; the table at ``path``, which it read, goes."""
    new = staged(df)
    discard(df.sparkSession, path)
    return new


def _with_shares(cells: DataFrame, targets: dict, share_of: dict[str, str]) -> DataFrame:
    """``cells`` with the target share of each dimension's category as a column (null
    for a category without tokens)."""
    out = cells
    for d, name in share_of.items():
        out = out.join(_shares(cells, d, targets[d]).withColumnRenamed("share", name), d, "left")
    return out.select(*cells.columns, *share_of.values())


def _miss(cells: DataFrame, share_of: dict[str, str]) -> float:
    """The largest difference between a raked share and its target (0 without
    tokens): one job over the cells."""
    if not share_of:
        return 0.0
    cells = cells.where("tokens > 0").withColumn("weight", F.col("factor") * F.col("tokens"))
    whole = cells.agg(F.sum("weight").alias("whole"))
    parts = [cells.groupBy(d).agg(F.sum("weight").alias("got"), F.max(s).alias("share")) for d, s in share_of.items()]
    both = parts[0].select("got", "share")
    for part in parts[1:]:
        both = both.unionByName(part.select("got", "share"))
    return both.agg(F.max(F.abs(F.col("got") / whole.scalar() - F.col("share")))).first()[0] or 0.0


def largest_miss(raked: DataFrame, targets: dict) -> float:
    """The largest difference between a share of ``raked`` cells and its target, over the
    categories of all dimensions (0 without tokens)."""
    share_of = {d: fresh(raked, f"_share_{d}") for d in targets}
    return _miss(_with_shares(raked, targets, share_of), share_of)


def _scale(raked: DataFrame, budget: float) -> float:
    """What factors are multiplied by to give probabilities (cut at 1): 1 / the
    largest factor, or what makes the expected tokens ``budget`` of all, if that
    is more.  Each round cuts further cells, so it ends; it reads only cells."""
    cells = raked.where("tokens > 0")
    top, total = cells.agg(F.max("factor"), F.sum("tokens")).first()
    if not top:
        return 1.0
    scale = 1.0 / top
    while True:
        whole = F.col("factor") * F.lit(scale) >= 1
        held, free = cells.agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)),
            F.sum(F.when(whole, 0.0).otherwise(F.col("factor") * F.col("tokens"))),
        ).first()
        if not free or held + scale * free >= budget * total * (1 - 1e-9):
            return scale
        scale = (budget * total - held) / free


def mixed(
    docs: DataFrame, targets: dict, id_column: str = "doc_id", text: str = "text", seed: int = SEED, out: str = "mix",
    budget: float = BUDGET, max_miss: float = MAX_MISS, **options,
) -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs``
    has that name): ``topic``, ``n_tokens``, ``factor``, ``probability`` and ``kept``.

    ``targets`` has a target (see ``_shares``) for some of "source", "lang" and
    "topic"; "topic" is the struct's, the others are columns of ``docs``.
    Targets that no weights meet together (a source found in one language only asks
    for another share than that language) are raked as near as the sweeps come, and a
    warning names the largest miss of a share if it is over ``max_miss``;
    ``largest_miss`` computes it from raked cells.  ``budget`` (0 to 1) is the least share of all tokens to expect in the
    sample; 0 keeps the marginals exact at any cost in size.
    Sampling is by a hash of id, text and seed: repeated rows share their fate
    and a run repeats.  Nulls are a category of their own; a null or empty text
    has no tokens.  An empty table gives no rows; other columns are carried.
    """
    out = fresh(docs, out)
    t, topic_name = fresh(docs, "_n_tokens"), fresh(docs, "_topic")
    rows = docs.withColumn(t, n_tokens(text)).withColumn(topic_name, topic(text, t))
    keys = {d: fresh(docs, f"_key_{d}") for d in targets}
    rows = rows.withColumns({keys[d]: _key(topic_name if d == "topic" else d) for d in targets})
    cells = rows.groupBy(*keys.values()).agg(F.sum(t).alias("tokens"))
    raked, miss = _raked(cells.toDF(*targets, "tokens"), targets, **options)
    if miss > max_miss:
        warnings.warn(f"the targets cannot be met together: a share misses its target by {miss:.3g}", stacklevel=2)
    scale = _scale(raked, budget)
    factor, p = fresh(docs, "_factor"), fresh(docs, "_p")
    raked = raked.select(
        *[F.col(d).alias(keys[d]) for d in targets],
        F.col("factor").alias(factor),
        F.least(F.col("factor") * F.lit(scale), F.lit(1.0)).alias(p),
    )
    # a table of one row for each cell: the planner knows its size
    rows = rows.join(raked, list(keys.values()))
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_column), F.col(text), F.lit(seed)), 11) / F.lit(float(1 << 53))
    mix = F.struct(
        F.col(topic_name).alias("topic"), F.col(t).alias("n_tokens"), F.col(factor).alias("factor"),
        F.col(p).alias("probability"), (draw < F.col(p)).alias("kept"),
    )
    return rows.withColumn(out, mix).select(*docs.columns, out)


def sample(docs: DataFrame, targets: dict, **options) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` keeps, with the same columns."""
    out = fresh(docs, "_mix")
    return mixed(docs, targets, out=out, **options).where(F.col(f"{out}.kept")).select(*docs.columns)
