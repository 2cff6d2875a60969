"""Questions about a whole history, answered in rounds of joins: who is reached, and how deep each commit lies.

Both are one problem: each commit's value is the greatest of a constant and of the values of some other commits plus a weight
(constants of heads and children's values for what heads reach; zero and parents' values plus one for generations). A round
folds every commit that depends on at most one other into all that depend on it: one that is known becomes a constant, one
with a single dependence hands on that dependence, with weights added. So a run of commits halves with each round, however
the runs branch; two dependences that come to the same commit become one; one that a longer way over another dependence
outweighs is dropped. A chain or a tree of n commits takes about log n rounds, and so do branches that part and meet again.

Where values have a top, as for what heads reach, one dependence at the top is enough. Each commit therefore also follows one way
of dependences, whatever others there are, in steps that double with each round, and takes another way if that one ends
nowhere: a main line of any number of merges is settled in about log n rounds.

What is left are merges that cross in ways no rule undoes. Each round still settles one level of them; after ROUNDS rounds a
rest that is counted to be at most REST rows is settled in one task, while a larger one goes on by levels.

Every round's rows are written to the shared folder and read again, so lineage does not grow and a lost task rereads files. A
commit with very many children is many rows that meet one, which adaptive execution splits; counts are pre-aggregated.

Edge cases: parents outside the table do not count; repeated commits are one, with the parents of all; a null sha is no commit;
an empty table gives an empty result; a cycle, which no history has, is a ValueError.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.sources.store import held

#: Rounds after which a small rest is settled in one task, and rows that are small.
ROUNDS, REST = 40, 1 << 18


class Rounds:
    """How many rounds a solution took, for those who ask."""

    count = 0


def _greatest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id", "source").agg(F.max("w").alias("w"))


def _undominated(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """Rows with a source, without dependences that a way over another dependence of the same commit outweighs.

    Ways over two dependences are found by one join; only commits with several dependences are asked about.
    """
    own = rows.join(wide.select("id"), "id", "left_semi")
    ahead = rows.select(F.col("id").alias("source"), F.col("source").alias("beyond"), F.col("w").alias("more"))
    reached = own.join(ahead, "source").groupBy("id", F.col("beyond").alias("source")).agg(F.max(F.col("w") + F.col("more")).alias("longer"))
    kept = rows.join(reached, ["id", "source"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("w")))
    back = reached.where("id = source").select("id", "source", F.col("longer").alias("w"))  # a way back to itself is kept, to be told
    return kept.select("id", "source", "w").unionByName(back)


def _followed(fast: DataFrame, told: DataFrame, top: int) -> DataFrame:
    """(id, source, lifted) of the commits that are not settled: how far each has followed one way; lifted where that is at the top.

    A way that ended nowhere is left for another dependence. A step that would land on a commit settled now is not taken.
    """
    settled = told.where("done").select(F.col("id").alias("source"), F.lit(True).alias("ended"), "c")
    here = fast.join(told.where("NOT done").select("id", "s"), "id").join(settled, "source", "left")
    there = told.where("NOT done").select(F.col("id").alias("source"), F.lit(True).alias("open"))
    steps = fast.join(there, "source", "left_semi").select(F.col("id").alias("source"), F.col("source").alias("beyond"))
    moved = here.join(steps, "source", "left").join(there, "source", "left")
    lifted = F.coalesce(F.col("ended") & (F.col("c") >= top), F.lit(False))
    source = F.when(F.col("open").isNull(), F.col("s")).otherwise(F.coalesce("beyond", "source"))
    return moved.select("id", source.alias("source"), lifted.alias("lifted"))


def solve(rows: DataFrame, top: int | None = None, rounds: Rounds | None = None, patience: int = ROUNDS, rest: int = REST) -> DataFrame:
    """(id, value): the greatest over each id's rows of w, plus the value of `source` where there is one; null if there is none.

    Every id needs a row without a source, whose w may be null. No value is over `top`, if given.
    """
    rounds = rounds or Rounds()
    rounds.count = 0
    rows, found, fast = held(_greatest(rows), "history"), None, None
    at_top = F.lit(False) if top is None else F.coalesce(F.col("c") >= top, F.lit(False))
    while True:
        rounds.count += 1
        told = rows.groupBy("id").agg(F.count("source").alias("n"), F.max(F.when(F.col("source").isNull(), F.col("w"))).alias("c"), F.max("source").alias("s"), F.max(F.when(F.col("source").isNotNull(), F.col("w"))).alias("ws"), F.bool_or(F.col("id") == F.col("source")).alias("own"))
        told = held(told.withColumn("done", (F.col("n") == 0) | at_top), "history-ids")
        n, done, wide, own = told.agg(F.count("*"), F.count_if("done"), F.count_if(~F.col("done") & (F.col("n") > 1)), F.bool_or("own")).first()
        if n and (own or not done):
            raise ValueError("the history has a cycle")
        settled = told.where("done").select("id", F.col("c").alias("value"))
        found = settled if found is None else found.unionByName(settled)
        if done == n:
            return found
        lifted = None
        if top is not None and wide:
            ways_ahead = told.where("NOT done").select("id", F.col("s").alias("source"))
            fast = held(ways_ahead.withColumn("lifted", F.lit(False)) if fast is None else _followed(fast, told, top), "history-ways")
            lifted = fast.where("lifted")
        known = told.where("done").select("id")
        # an id's own value meets nothing: kept apart, as rows without a source would all come to one task of a join by source
        own_values, left = told.where("NOT done").select("id", F.col("c").alias("w")), rows.where("source IS NOT NULL")
        if top is not None:  # else a settled commit has no dependences left
            left = left.join(known, "id", "left_anti")
        if wide:
            left = _undominated(left, told.where("NOT done AND n > 1"))
        # one that waits for a value known now has its own turn to take it in; it hands nothing on before
        handing = told.where("NOT done AND n = 1").join(known.select(F.col("id").alias("s")), "s", "left_anti")
        folded = told.where("done").unionByName(handing).select(F.col("id").alias("__id"), F.lit(True).alias("known"), *[F.when(F.col("done"), F.lit(None)).otherwise(F.col(x)).alias(x) for x in ("s", "ws")], "c")
        met = left.join(folded, F.col("source") == F.col("__id"), "left")
        none = F.lit(None).cast(dict(rows.dtypes)["source"])
        ways = F.when(F.col("known"), F.array(F.struct(F.col("s").alias("source"), (F.col("w") + F.col("ws")).alias("w")), F.struct(none.alias("source"), (F.col("w") + F.col("c")).alias("w")))).otherwise(F.array(F.struct("source", "w")))
        # a way that leads nowhere has no weight
        following = met.select("id", F.explode(ways).alias("x")).select("id", "x.*").where("w IS NOT NULL").unionByName(own_values.select("id", none.alias("source"), "w"))
        if lifted is not None:
            following = following.unionByName(lifted.select("id", none.alias("source"), F.lit(top).cast("bigint").alias("w")))
        rows = held(_greatest(following), "history")
        if rounds.count >= patience and rows.limit(rest + 1).count() <= rest:
            return found.unionByName(_in_one_task(rows))


def _in_one_task(rows: DataFrame) -> DataFrame:
    """The values of a rest of counted size."""
    kinds = dict(rows.dtypes)

    def settle(whole: pd.DataFrame) -> pd.DataFrame:
        place = {k: i for i, k in enumerate(dict.fromkeys(map(_plain, whole["id"])))}
        value: list[int | None] = [None] * len(place)
        waits, after = [0] * len(place), defaultdict(list)
        for k, s, w in zip(map(_plain, whole["id"]), map(_plain, whole["source"]), whole["w"], strict=True):
            if s is None:
                value[place[k]] = None if pd.isna(w) else int(w)
            else:
                waits[place[k]] += 1
                after[place[s]].append((place[k], int(w)))
        ready, seen = [i for i, n in enumerate(waits) if not n], 0
        while ready:
            i = ready.pop()
            seen += 1
            for j, w in after[i]:
                if value[i] is not None and (value[j] is None or value[i] + w > value[j]):
                    value[j] = value[i] + w
                waits[j] -= 1
                if not waits[j]:
                    ready.append(j)
        if seen < len(place):
            raise ValueError("the history has a cycle")
        first = whole.drop_duplicates("key") if "key" in whole else whole.assign(key=list(map(_plain, whole["id"]))).drop_duplicates("key")
        return pd.DataFrame({"id": first["id"].tolist(), "value": pd.array([value[place[_plain(k)]] for k in first["id"]], dtype="Int64")})

    return rows.groupBy(F.lit(0).alias("all")).applyInPandas(settle, f"id {kinds['id']}, value long")


def _plain(key):
    """An id as pandas has it, as something that can be looked up."""
    return tuple(key.values()) if isinstance(key, dict) else tuple(key) if isinstance(key, tuple) else None if key is None or key is pd.NA or key != key else key


def _commits(commits: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(id) of the commits, and (id, parent) of those parents that are commits; an id is the sha, with the columns of `by` if any."""
    own: Column = F.struct(*by, "sha") if by else F.col("sha")
    up: Column = F.struct(*by, F.col("parent").alias("sha")) if by else F.col("parent")
    known = commits.where("sha IS NOT NULL").select(*by, "sha", "parent_shas")
    ids = known.select(own.alias("id")).distinct()
    edges = known.select(*by, "sha", F.explode("parent_shas").alias("parent")).where("parent IS NOT NULL").select(own.alias("id"), up.alias("parent")).distinct()
    return ids, edges.join(ids.select(F.col("id").alias("parent")), "parent", "left_semi")


def _named(found: DataFrame, by: tuple[str, ...]) -> list[Column]:
    return [F.col(f"id.{c}").alias(c) for c in (*by, "sha")] if by else [F.col("id").alias("sha")]


def generations(commits: DataFrame, *by: str, rounds: Rounds | None = None, **settings: int) -> DataFrame:
    """(*by, sha, generation): 0 for commits without parents, else one more than the deepest parent's.

    Ordered by generation and sha, commits come after all their ancestors, whatever their dates say.
    """
    ids, edges = _commits(commits, by)
    none = F.lit(None).cast(dict(ids.dtypes)["id"])
    rows = ids.select("id", none.alias("source"), F.lit(0).cast("bigint").alias("w")).unionByName(edges.select("id", F.col("parent").alias("source"), F.lit(1).cast("bigint").alias("w")))
    found = solve(rows, rounds=rounds, **settings)
    return found.select(*_named(found, by), F.col("value").alias("generation"))


def ancestors(commits: DataFrame, heads: DataFrame, *by: str, rounds: Rounds | None = None, **settings: int) -> DataFrame:
    """(*by, sha): what each group's heads reach, themselves included; heads that are no commits are left out."""
    ids, edges = _commits(commits, by)
    none = F.lit(None).cast(dict(ids.dtypes)["id"])
    starts = heads.where("sha IS NOT NULL").select((F.struct(*by, "sha") if by else F.col("sha")).alias("id")).distinct().withColumn("head", F.lit(0).cast("bigint"))
    own = ids.join(starts, "id", "left").select("id", none.alias("source"), F.col("head").alias("w"))
    rows = own.unionByName(edges.select(F.col("parent").alias("id"), F.col("id").alias("source"), F.lit(0).cast("bigint").alias("w")))
    found = solve(rows, top=0, rounds=rounds, **settings).where("value IS NOT NULL")
    return found.select(*_named(found, by))


def out_of_order(commits: DataFrame, place: str = "pos") -> DataFrame:
    """(sha, parent) where a commit's place in an order, oldest first, is not after its parent's."""
    up = commits.select("sha", F.col(place).alias("__own"), F.explode("parent_shas").alias("parent"))
    return up.join(commits.select(F.col("sha").alias("parent"), F.col(place).alias("__its")), "parent").where("__own <= __its").select("sha", "parent").distinct()
