"""Periodic runs of words: maximal repetitions from suffix-tree extensions of Lyndon roots.

A run of period q holds a Lyndon word of length q (its least rotation, in the order of the words or in the reversed
order) that is the longest Lyndon word where it starts.  So the longest Lyndon words of both orders are all candidates
for roots.  Each is extended to both sides by longest common extensions: Ukkonen's suffix tree of the words gives the
right one, the tree of the reversed words the left one.  The string depth of the lowest common ancestor of two leaves
is the least branching depth between them in the Euler tour, a range minimum in constant time.

A run of at least m words has m/2 consecutive words or more that stand again a period later.  So every word of a run
lies in a window of m/2 words that stands twice in the text, and trees are only built of the stretches that such windows
cover; texts without any, which are most, need no tree.  The memory of a tree is about 1 KB a word of its stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.texts import fresh_name, map_texts

#: Multiplier of the rolling hash of windows; equal hashes of unlike windows only cost work.
MIX = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Ukkonen's tree of integers above 0; an end mark 0, less than all, is added.

    ``order`` has the suffixes by the tour of the leaves, children in rising order; ``backward`` the same with falling
    order of all but the end mark, which stays first.
    """

    def __init__(self, symbols: list[int], backward: bool = False):
        text = [*symbols, 0]
        n = len(text)
        begin, stop, link, kids, suffix = [0], [0], [0], [{}], [-1]

        def leaf(at: int, start: int) -> int:
            begin.append(at)
            stop.append(n)
            link.append(0)
            kids.append(None)
            suffix.append(start)
            return len(begin) - 1

        active = edge = length = pending = 0
        for i, c in enumerate(text):
            pending += 1
            last = 0
            while pending:
                if not length:
                    edge = i
                child = kids[active].get(text[edge])
                if child is None:
                    kids[active][c] = leaf(i, i - pending + 1)
                    if last:
                        link[last] = active
                        last = 0
                else:
                    size = (stop[child] if stop[child] <= i else i + 1) - begin[child]
                    if length >= size:
                        edge += size
                        length -= size
                        active = child
                        continue
                    at = begin[child]
                    if text[at + length] == c:
                        length += 1
                        if last:
                            link[last] = active
                        break
                    split = len(begin)
                    begin.append(at)
                    stop.append(at + length)
                    link.append(0)
                    kids.append({text[at + length]: child})
                    suffix.append(-1)
                    kids[active][text[edge]] = split
                    begin[child] = at + length
                    kids[split][c] = leaf(i, i - pending + 1)
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if active:
                    active = link[active]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self._begin, self._stop, self._kids, self._suffix = begin, stop, kids, suffix
        order, depths = self._tour(falling=False)
        self.order = np.array(order)
        self.backward = np.array(self._tour(falling=True)[0]) if backward else None
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        self._least = [np.array(depths, np.int32)]
        while 2 << len(self._least) - 1 <= n:
            row, width = self._least[-1], 1 << len(self._least) - 1
            self._least.append(np.minimum(row[:-width], row[width:]))
        del self._begin, self._stop, self._kids, self._suffix

    def _tour(self, falling: bool) -> tuple[list[int], list[int]]:
        """Suffixes in the order of the tour, and before each one the depth of the node at which the tour branched."""
        begin, stop, kids, suffix = self._begin, self._stop, self._kids, self._suffix
        order, depths, branch = [], [], 0
        waiting = [(0, 0, True)]
        while waiting:
            node, depth, first = waiting.pop()
            if not first:
                branch = depth
            below = kids[node]
            if below is None:
                order.append(suffix[node])
                depths.append(branch)
                continue
            depth += stop[node] - begin[node]
            marks = sorted(below, reverse=not falling)  # the stack turns them round
            if falling and marks[0] == 0:
                marks.append(marks.pop(0))
            top = len(marks) - 1
            waiting += [(below[c], depth, k == top) for k, c in enumerate(marks)]
        return order, depths

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of each pair of unlike suffixes: depth of the lowest common ancestor."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(high - low)[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            which = level == k
            row = self._least[k]
            found[which] = np.minimum(row[low[which]], row[high[which] - (1 << int(k))])
        return found


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word that starts at each position: the next suffix of smaller rank."""
    ranks, n = rank.tolist(), len(rank) - 1
    ends = [0] * n
    for i in range(n - 1, -1, -1):
        j, own = i + 1, ranks[i]
        while ranks[j] > own:
            j = ends[j]
        ends[i] = j
    return np.array(ends, np.int64)


def runs_of(symbols: list[int], least: int) -> np.ndarray:
    """``(start, period, length)`` of every run of ``least`` symbols or more, by start, then period."""
    n = len(symbols)
    forward, reverse = SuffixTree(symbols, backward=True), SuffixTree(symbols[::-1])
    falling = np.empty(n + 1, np.int64)
    falling[forward.backward] = np.arange(n + 1)
    start = np.tile(np.arange(n), 2)
    end = np.concatenate([lyndon_ends(forward.rank), lyndon_ends(falling)])
    period = end - start
    # Left of position i the reversed text goes on at n - i; right of the last symbol both have the end mark.
    left, right = reverse.common(n - start, n - end), forward.common(start, end)
    length = left + period + right
    long = (length >= 2 * period) & (length >= least)
    return np.unique(np.stack([start - left, period, length], axis=1)[long], axis=0)


def stretches(hashes: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of words covered by windows of ``window`` words that stand twice or more."""
    places = len(hashes) - window + 1
    if places < 2:
        return []
    words = hashes.view(np.uint64)
    rolled = np.zeros(places, np.uint64)
    for k in range(window):
        rolled = rolled * MIX + words[k : k + places]
    order = np.argsort(rolled, kind="stable")
    same = np.diff(rolled[order]) == 0
    if not same.any():
        return []
    found = np.zeros(places, bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int32)
    change[:places] += found
    change[window:] -= found
    covered = np.diff(np.cumsum(change[:-1]) > 0, prepend=False, append=False)
    edges = np.flatnonzero(covered)
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def runs_of_words(words: list[bytes], least: int) -> np.ndarray:
    """``(start, period, length)`` of every run of a text of ``least`` words or more, by start, then period."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    found = []
    for a, b in stretches(hashes, (least + 1) // 2):
        if b - a >= least:
            known: dict[bytes, int] = {}
            rows = runs_of([known.setdefault(w, len(known) + 1) for w in words[a:b]], least)
            rows[:, 0] += a
            found.append(rows)
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that stand in no run behind its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    start, period, length = runs.T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: int = 12) -> DataFrame:
    """Columns ``keep`` (all) of each row, n_words, its ``runs`` and the ``collapsed`` text (UTF-8 bytes).

    Words are what white space (ASCII) separates.  A run is a stretch of words with smallest period q, at least
    ``least`` words and two periods long, that no neighbouring word extends; ``runs`` has (start, length, period) of
    all of them by start, then period.  ``collapsed`` leaves of each run its first period, unless another run drops it.
    NULL and empty texts have no words, no run and an empty collapsed text.  Repeated rows stay; an empty table gives an
    empty one.  Kept columns named like the new ones would clash: a new column then gets a name that is free.
    """
    columns = docs.columns if keep is None else keep
    kept = docs.select(*[f"`{c}`" for c in columns])
    names = [fresh_name(kept, n) for n in ("n_words", "runs", "collapsed")]

    def work(texts: list[bytes]) -> dict[str, list]:
        sizes, starts, rows, rest = [], [0], [], []
        for data in texts:
            words = data.split()
            runs = runs_of_words(words, least)
            sizes.append(len(words))
            rows.append(runs)
            starts.append(starts[-1] + len(runs))
            rest.append(collapsed(words, runs))
        start, period, length = np.concatenate(rows).T
        values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (start, length, period)], fields=list(_RUN_TYPE.value_type))
        spans = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values, type=_RUN_TYPE)
        return dict(zip(names, (pa.array(sizes, pa.int64()), spans, pa.array(rest, pa.binary())), strict=True))

    made = f"`{names[0]}` bigint, `{names[1]}` {RUNS}, `{names[2]}` binary"
    return map_texts(docs, text, columns, work, made)


def planted(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text; a tenth of the texts, by the checksum of the id, repeat some of their words up to the end.

    With h the checksum and g = h div 10, words from a = g mod n on repeat those from a with period 1 + (n - a) div (3 + g mod 8).
    Texts without words and rows with a NULL id stay as they are.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.expr(r"if(_h % 10 = 0, filter(split(text, '[ \t-\r]+'), x -> x <> ''), null)")
    rows = rows.withColumn("_words", words).withColumn("_n", F.expr("cast(size(_words) as bigint)")).withColumn("_g", F.expr("_h div 10"))
    rows = rows.withColumn("_a", F.expr("if(_n > 0, _g % _n, null)"))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    again = F.expr("array_join(transform(_words, (x, i) -> if(i < _a, x, _words[cast(_a + (i - _a) % _p as int)])), ' ')")
    return rows.select("doc_id", F.when(F.col("_n") > 0, again).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """Number of runs of each text, its longest run (of equal ones the first, then that of least period) and digests.

    Texts without a run have NULLs for it; runs_sha256 is that of a line ``start,length,period`` for each run.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = find_runs(rows, "text", ["doc_id"], least)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("_best", longest)
    start, length, period = -F.col("_best.start"), F.col("_best.length"), -F.col("_best.period")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(_best.length * 1000) div (-_best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
