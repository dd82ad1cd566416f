"""Mixing sources to target weights by hierarchical token budgets, with DataFrame operations only.

A budget of tokens goes down a tree of domain, language and source. At each node it is shared among
the children by weight, but none gets more than its documents can give in the allowed number of
epochs; what one cannot take goes to its siblings by weight, and only what all of them cannot take is left
to the siblings of their parent. Each leaf then takes whole epochs, and of one more epoch, in an order that
depends on the seed, the longest prefix of documents that its budget pays for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewsieve.session import WrittenTable, write_once

# Sources of each domain; all others are "other".
DOMAINS = {
    "web": tuple(f"src{i}" for i in range(10)),
    "books": tuple(f"src{i}" for i in range(10, 15)),
    "reference": tuple(f"src{i}" for i in range(15, 18)),
}
# Whole weights of nodes by name, for each level; 1 where there is none.
WEIGHTS = ({"web": 4, "books": 3, "reference": 2, "other": 1}, {"en": 5, "de": 2, "es": 2, "fr": 2}, {})
SHARE = 0.6  # of all tokens: the budget
EPOCHS = 4
SEED = 17
_LEVELS = ("domain", "lang", "source")
# The order of an epoch is refined by this many hexadecimal digits at a time ...
DIGITS = 3
# ... until no more than so many rows of a leaf lie around the end of its prefix.
LAST_ROWS = 10_000


def domain_of(source: Column) -> Column:
    out = F.lit("other")
    for name, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), F.lit(name)).otherwise(out)
    return out


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _weight(level: int, weights: Sequence[dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, weight in weights[level].items():
        out = F.when(F.col(_LEVELS[level]) == name, F.lit(weight)).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`given` to each node of its parent's `budget`: by `weight`, up to its `room`; what is not taken goes to its siblings.

    Ordered by room for each unit of weight, the nodes that are filled come first: those whose room is no more than
    their part of what is left to them and to all that follow.
    """
    siblings = Window.partitionBy(*parent)
    ranked = nodes.withColumn("room", F.when(F.col("weight") > 0, F.col("room")).otherwise(0).cast("long"))
    ranked = ranked.withColumn("ratio", F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(0.0))
    before = siblings.orderBy("ratio", *order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0))
    weight_left = F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level", F.when(weight_left > 0, left / weight_left))
    full = F.coalesce(F.col("ratio") <= F.col("level"), F.lit(True))
    # All that are not filled get the level of the first of them.
    first = F.min(F.when(~full, F.struct("ratio", *order, "level"))).over(siblings)["level"]
    ranked = ranked.withColumn("given", F.when(full, F.col("room").cast("double")).otherwise(F.col("weight") * first))
    return ranked.drop("ratio", "level")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Sequence[dict[str, int]], epochs: int) -> DataFrame:
    """Budget of each leaf (domain, lang, source, tokens), in whole tokens, and its whole epochs and the rest."""
    leaves = leaves.withColumn("room", (F.col("tokens") * epochs).cast("long"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("room").alias("room"))
    domains = langs.groupBy("domain").agg(F.sum("room").alias("room"))
    given = domains.withColumn("weight", _weight(0, weights)).withColumn("budget", budget.cast("double")).withColumn("root", F.lit(0))
    given = share_out(given, ["root"], ["domain"]).select("domain", F.col("given").alias("budget"))
    for depth, children in ((1, langs), (2, leaves)):
        above, below = _LEVELS[:depth], _LEVELS[: depth + 1]
        parent = given.select(*[F.col(c).alias(f"up_{c}") for c in above], "budget")
        same = [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in above]
        nodes = children.withColumn("weight", _weight(depth, weights)).join(parent, on=same).drop(*[f"up_{c}" for c in above])
        given = share_out(nodes, above, [_LEVELS[depth]])
        given = given.select(*below, *(["tokens"] if depth == 2 else []), F.col("given").alias("budget"))
    whole = F.floor(F.col("budget"))
    full = F.when(F.col("tokens") > 0, F.floor(whole / F.col("tokens"))).otherwise(0).cast("long")
    return given.select(*_LEVELS, "tokens", whole.cast("long").alias("budget"), full.alias("epochs"), (whole - full * F.col("tokens")).cast("long").alias("rest"))


def _order(seed: int, id_col: str) -> Column:
    """Place of a document in the epoch that its leaf takes in part: an MD5 in hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def _beside(rows: DataFrame, leaves: DataFrame, columns: Sequence[str]) -> DataFrame:
    right = leaves.select(*[F.col(c).alias(f"leaf_{c}") for c in _LEVELS], *columns)
    return rows.join(right, on=[F.col(c).eqNullSafe(F.col(f"leaf_{c}")) for c in _LEVELS]).drop(*[f"leaf_{c}" for c in _LEVELS])


def prefix_ends(rows: DataFrame, budgets: WrittenTable, seed: int, last_rows: int = LAST_ROWS) -> WrittenTable:
    """Where each leaf's prefix ends: documents whose place starts below `prefix`, or is at most `last`, belong to it.

    Tokens are summed up by leaf and leading digits of the place, in steps, so only the few rows around the end of a
    prefix are ever ordered one by one.
    """
    leaf = list(_LEVELS)
    ends = write_once(budgets.data.select(*leaf, "tokens", "budget", "epochs", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before")), "ends")
    digits = 0
    while True:
        state = ends.sized_for_join()
        near = _beside(rows, state, ["epochs", "rest", "prefix", "before"]).withColumn("place", _order(seed, "doc_id"))
        near = near.where(F.substring("place", 1, digits) == F.col("prefix") if digits else F.lit(True))
        if digits and (digits >= 30 or most <= last_rows):
            break
        digits += DIGITS
        pieces = near.groupBy(*leaf, "rest", "before", F.substring("place", 1, digits).alias("piece")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("n_rows"))
        w = Window.partitionBy(*leaf).orderBy("piece")
        start = F.col("before") + F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        crossed = pieces.withColumn("start", start).where("start <= rest AND rest < start + n")
        found = crossed.select(*leaf, F.col("piece").alias("new_prefix"), F.col("start").alias("new_before"), "n_rows")
        old = ends.data.drop("prefix", "before")
        # Where the rest pays for all (an empty leaf), the end is above all places.
        new = _beside_left(old, found, ["new_prefix", "new_before", "n_rows"])
        following = write_once(
            new.select(*leaf, "tokens", "budget", "epochs", "rest", F.coalesce("new_prefix", F.lit("g")).alias("prefix"), F.coalesce("new_before", F.lit(0)).alias("before"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")),
            "ends",
        )
        ends.remove()
        ends = following
        most = ends.data.agg(F.max("n_rows")).first()[0] or 0
    paid = F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*leaf).orderBy("place")) <= F.col("rest")
    last = near.withColumn("paid", paid).where("paid").groupBy(*leaf).agg(F.max("place").alias("last"))
    out = _beside_left(ends.data.drop("before", "n_rows"), last, ["last"])
    done = write_once(out.withColumn("digits", F.lit(digits)), "ends")
    ends.remove()
    return done


def _beside_left(leaves: DataFrame, more: DataFrame, columns: Sequence[str]) -> DataFrame:
    right = more.select(*[F.col(c).alias(f"leaf_{c}") for c in _LEVELS], *columns)
    return leaves.join(right, on=[F.col(c).eqNullSafe(F.col(f"leaf_{c}")) for c in _LEVELS], how="left").drop(*[f"leaf_{c}" for c in _LEVELS])


def _plan(rows: DataFrame, share: float, weights: Sequence[dict[str, int]], epochs: int, seed: int, last_rows: int) -> WrittenTable:
    """Budget and end of the prefix of each leaf of rows (doc_id, domain, lang, source, n_tokens)."""
    leaves = write_once(rows.groupBy(*_LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    total = leaves.data.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budgets = write_once(leaf_budgets(leaves.data, F.lit(int(total * share)), weights, epochs), "budgets")
    ends = prefix_ends(rows, budgets, seed, last_rows)
    leaves.remove()
    budgets.remove()
    return ends


def _copies(seed: int) -> Column:
    place = _order(seed, "doc_id")
    inside = (F.substring(place, F.lit(1), F.col("digits")) < F.col("prefix")) | F.coalesce(place <= F.col("last"), F.lit(False))
    return (F.col("epochs") + inside.cast("long")).alias("copies")


def _narrow(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    source = F.col(source_col).cast("string")
    return docs.select(*more, F.col(id_col).alias("doc_id"), domain_of(source).alias("domain"), F.col(lang_col).cast("string").alias("lang"), source.alias("source"), n_tokens(F.col(text_col)).alias("n_tokens"))


def mixture(
    docs: DataFrame,
    share: float = SHARE,
    weights: Sequence[dict[str, int]] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    last_rows: int = LAST_ROWS,
) -> DataFrame:
    """How often each document is taken.

    Returns one row per row: doc_id, domain, lang, source, n_tokens, budget (whole tokens of its leaf) and
    copies. The budget is `share` of all tokens; unnamed nodes weigh 1, and a node of weight 0 gets nothing.

    A null language or source is a node of its own; a null or empty text has no tokens. Rows of one id, or of a null
    id, stand at one place of the order and are taken together. Leaves without tokens take nothing. Empty tables give no rows;
    other columns are not read.
    """
    rows = write_once(_narrow(docs, id_col, text_col, lang_col, source_col), "tokens")
    plan = _plan(rows.data, share, weights, epochs, seed, last_rows)
    return _beside(rows.data, plan.sized_for_join(), ["budget", "epochs", "prefix", "digits", "last"]).select(F.col("doc_id").alias(id_col), *_LEVELS, "n_tokens", "budget", _copies(seed))


def mixed_documents(
    docs: DataFrame,
    share: float = SHARE,
    weights: Sequence[dict[str, int]] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    last_rows: int = LAST_ROWS,
) -> DataFrame:
    """The documents themselves, each as often as `mixture` takes it, with all their columns.

    Only the plan of the leaves is joined to the documents, by broadcast if it is small, so texts do not move.
    """
    rows = write_once(_narrow(docs, id_col, text_col, lang_col, source_col), "tokens")
    plan = _plan(rows.data, share, weights, epochs, seed, last_rows)
    rows.remove()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    source = F.col(source_col).cast("string")
    beside = docs.select(whole, F.col(id_col).alias("doc_id"), domain_of(source).alias("domain"), F.col(lang_col).cast("string").alias("lang"), source.alias("source"))
    taken = _beside(beside, plan.sized_for_join(), ["epochs", "prefix", "digits", "last"]).select("whole", _copies(seed))
    return taken.where("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("whole.*")
