"""Problem 9: filling containers of fixed capacity, holding a mixture of sources in every window.

Each source's items are put in an order by a hash, and cut into lots by the tokens before them: a lot takes from every
source its target share of so many tokens, so what a lot has over or lacks, less than one item of each source, is
carried to the next. Tokens before an item are sums over hash buckets, of ranges of buckets, and within its bucket, so
no task sees all items, all buckets or all of a hot source.

In a lot the sources are queues served by deficit round-robin. A window is so many containers; each source earns its
share of the window's room, takes items while its credit covers them, and carries what it lacks or has over to the next
window. The items of a window go, the largest first, where they fit most tightly, and only into the window's own
containers; what doesn't fit goes back to its queue with its credit, and gaps are filled with items of the sources that
lack most. So the mixture holds in the windows as they come out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checked_rows, cut_lineage, each_of, parts_for
from .encode import token_counts

#: Items of a lot on average; buckets of a range; containers of a window at least, and its tokens at least; items of a queue that are tried for a gap; share of a window's room that a source may be ahead for it.
LOT_ITEMS, RANGE, WINDOW_CONTAINERS, WINDOW_TOKENS, LOOK, AHEAD = 8_000, 4_096, 32, 1 << 17, 64, 0.01
COLUMNS = ["clase", "contenedor", "ventana", "doc_id", "parte", "token_ini", "tokens"]
OUT = "clase string, contenedor string, ventana string, doc_id {0}, parte int, token_ini int, tokens int"


def window_tokens(capacity):
    """The room of a window, a number or a column."""
    if isinstance(capacity, int):
        return capacity * max(WINDOW_CONTAINERS, -(-WINDOW_TOKENS // capacity))
    return capacity * F.greatest(F.lit(WINDOW_CONTAINERS), F.ceil(WINDOW_TOKENS / capacity))


def fill(queues: dict[str, deque], capacity: int, containers: int) -> Iterator[list[list[tuple]]]:
    """Windows of containers, each a list of items (tokens, ...), until the queues are empty; a source's share is its share of the tokens that are left."""
    left = {s: sum(x[0] for x in q) for s, q in queues.items()}
    credit = dict.fromkeys(queues, 0.0)
    while (total := sum(left.values())) > 0:
        n = min(containers, -(-total // capacity))
        order = sorted(s for s in queues if queues[s])
        for s in order:
            credit[s] += n * capacity * left[s] / total
        room = [(capacity, c) for c in range(n)]  # free tokens and number of the containers, sorted
        out: list[list[tuple]] = [[] for _ in range(n)]

        def put(item: tuple, s: str) -> bool:
            k = bisect_left(room, (item[0], -1))
            if k == len(room):
                return False
            free, c = room.pop(k)
            out[c].append(item)
            credit[s] -= item[0]
            left[s] -= item[0]
            if free > item[0]:
                insort(room, (free - item[0], c))
            return True

        taken, spent = [], dict.fromkeys(order, 0)
        for s in order:
            while queues[s] and spent[s] + queues[s][0][0] <= credit[s]:
                taken.append((queues[s].popleft(), s))
                spent[s] += taken[-1][0][0]
        back = [(item, s) for item, s in sorted(taken, key=lambda x: (-x[0][0], *x[0][1:4], x[1])) if not put(item, s)]
        for item, s in back:
            queues[s].appendleft(item)
        # gaps: of the source that lacks most the largest item that fits
        while room:
            for s in sorted(order, key=lambda s: (-credit[s], s)):
                most = min(room[-1][0], credit[s] + AHEAD * n * capacity)
                fits = [(x[0], -k) for k, x in enumerate(islice(queues[s], LOOK)) if x[0] <= most]
                if fits:
                    k = -max(fits)[1]
                    item = queues[s][k]
                    del queues[s][k]
                    put(item, s)
                    break
            else:
                break
        if not any(out):  # nobody's credit covers an item yet: the one that lacks most goes first
            s = max((s for s in order), key=lambda s: (credit[s], s))
            put(queues[s].popleft(), s)
        yield [c for c in out if c]


def pack(df: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path: str | None = None, lot_items: int = LOT_ITEMS, targets: dict[str, float] | None = None) -> DataFrame:
    """clase, contenedor, ventana, doc_id, parte, token_ini, tokens: where each item, or part of an item longer than the capacity, goes, in each class.

    targets: the share of tokens that each source shall have in every window (a null source is ""), by default its
    share of all tokens. Sources that run out leave later lots to the others; sources without a target come in lots of
    their own at the end. An item without tokens takes no room: its contenedor is null. Repeated rows are items of
    their own.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    kinds = [(r["clase"], int(r["capacidad"])) for r in checked_rows(classes.select("clase", "capacidad").dropna().distinct(), 1000, "contenedores")]
    if any(c <= 0 for _, c in kinds):
        raise ValueError("capacidad must be positive")
    if targets is not None and (not targets or min(targets.values()) < 0 or sum(targets.values()) <= 0):
        raise ValueError("targets must be shares, not all zero")
    named = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("fuente"), F.col(text_col).alias("_t"))
    sized = cut_lineage(token_counts(named, ["doc_id", "fuente"], "_t", path))
    totals = sized.agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).first()
    lots = parts_for(totals["n"], lot_items)
    lot_tokens = max(1.0, (totals["t"] or 0) / lots)
    items = sized.filter("tokens > 0").withColumn("orden", F.xxhash64("doc_id", "tokens")).withColumn("cubo", F.pmod("orden", F.lit(lots)).cast("int"))

    by = items.groupBy("fuente", "cubo").agg(F.sum("tokens").alias("n")).withColumn("tramo", F.floor(F.col("cubo") / RANGE))
    spans = by.groupBy("fuente", "tramo").agg(F.sum("n").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("fuente").orderBy("tramo")) - F.col("_n")
    spans = spans.select("fuente", "tramo", before.alias("_antes"), F.sum("_n").over(W.partitionBy("fuente")).alias("_de"))
    within = F.sum("n").over(W.partitionBy("fuente", "tramo").orderBy("cubo")) - F.col("n")
    starts = by.withColumn("_en", within).join(spans, ["fuente", "tramo"]).select("fuente", "cubo", (F.col("_antes") + F.col("_en")).alias("_antes"), "_de")
    running = F.sum("tokens").over(W.partitionBy("fuente", "cubo").orderBy("orden", "doc_id").rowsBetween(W.unboundedPreceding, -1))
    placed = items.withColumn("_r", F.coalesce(running, F.lit(0))).join(starts, ["fuente", "cubo"])
    own = F.col("_de") / F.lit(float(totals["t"] or 1))
    if targets is not None:
        whole = sum(targets.values())
        own = F.coalesce(F.create_map(*(F.lit(x) for s, v in targets.items() for x in (s, float(v / whole))))[F.col("fuente")], F.lit(0.0))
    at = F.floor((F.col("_antes") + F.col("_r")) / (own * lot_tokens))
    # without a target, lots of their own behind all others
    rest = F.lit(2**40) + F.floor((F.col("_antes") + F.col("_r")) / lot_tokens)
    placed = placed.withColumn("lote", F.when(own > 0, F.least(at, F.lit(2**40 - 1))).otherwise(rest)).select("doc_id", "fuente", "tokens", "orden", "lote")

    def run(key, one):
        clase, lote = key
        if one.empty:
            return pd.DataFrame([], columns=COLUMNS)
        capacity = int(one["capacidad"].iloc[0])
        queues: dict[str, deque] = {}
        for source, order, doc, tokens in sorted(zip(one["fuente"], one["orden"], one["doc_id"], one["tokens"]), key=lambda r: (*r[:2], str(r[2]))):
            for part, begin in enumerate(range(0, tokens, capacity)):
                queues.setdefault(source, deque()).append((min(capacity, tokens - begin), order, part, begin, doc))
        out, number = [], 0
        for window, done in enumerate(fill(queues, capacity, window_tokens(capacity) // capacity)):
            for c in done:
                out += [(clase, f"{clase}-{lote:06d}-{number:06d}", f"{clase}-{lote:06d}-{window:04d}", doc, part, begin, tokens) for tokens, _, part, begin, doc in c]
                number += 1
        return pd.DataFrame(out, columns=COLUMNS)

    names = ["clase", "capacidad"]
    packed = each_of(placed, kinds, names).groupBy("clase", "lote").applyInPandas(run, OUT.format(id_type))
    empty = each_of(sized.filter("tokens = 0"), kinds, names)
    none = F.lit(None).cast("string")
    return packed.unionByName(empty.select("clase", none.alias("contenedor"), none.alias("ventana"), "doc_id", F.lit(0).alias("parte"), F.lit(0).alias("token_ini"), "tokens"))


def deviations(packed: DataFrame, df: DataFrame, id_col: str = "doc_id", source_col: str = "source", targets: dict[str, float] | None = None) -> DataFrame:
    """clase, ventana, tokens, desviacion: of each window the largest difference between a source's share of its tokens and that source's target, by default its share of all tokens of the class. df must have each id once."""
    x = packed.filter("ventana is not null").join(df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("fuente")), "doc_id")
    by = x.groupBy("clase", "ventana", "fuente").agg(F.sum("tokens").alias("n"))
    if targets is None:
        goal = by.groupBy("clase", "fuente").agg(F.sum("n").alias("_s"))
        goal = goal.join(by.groupBy("clase").agg(F.sum("n").alias("_t")), "clase").select("clase", "fuente", (F.col("_s") / F.col("_t")).alias("meta"))
    else:
        each = F.array(*(F.struct(F.lit(s).alias("fuente"), F.lit(float(v / sum(targets.values()))).alias("meta")) for s, v in targets.items()))
        goal = by.select("clase").distinct().select("clase", F.inline(each))
    whole = by.groupBy("clase", "ventana").agg(F.sum("n").alias("tokens"))
    # of a source that a window lacks the difference is its target
    seen = by.join(whole, ["clase", "ventana"]).join(goal, ["clase", "fuente"], "left").withColumn("meta", F.coalesce("meta", F.lit(0.0)))
    far = seen.groupBy("clase", "ventana", "tokens").agg(F.max(F.abs(F.col("n") / F.col("tokens") - F.col("meta"))).alias("_a"), F.collect_set("fuente").alias("_f"))
    goals = goal.groupBy("clase").agg(F.collect_list(F.struct("fuente", "meta")).alias("_g"))
    lacking = F.coalesce(F.array_max(F.transform(F.filter("_g", lambda g: ~F.array_contains("_f", g["fuente"])), lambda g: g["meta"])), F.lit(0.0))
    return far.join(goals, "clase").select("clase", "ventana", "tokens", F.greatest("_a", lacking).alias("desviacion"))
