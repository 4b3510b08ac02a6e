"""Periodic runs of words: seed and extend along diagonals.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 q)`` words long, that no
neighbouring word extends keeping the period. Word i against word i + q is a diagonal, its lag q; a run of
length L matches L - q words along its diagonal, never fewer than ``max(q, least - q)``.

* *Index.* For lags in a band [k, 2k) every run matches at least k words, so its diagonal holds two equal
  k-grams at that lag. The grams of one document are named exactly (equal names, equal grams) by doubling; grams that
  stand once in their document are left out at each step, so that long grams cost little.
* *Pairs.* Occurrences of one gram that follow each other by at most k/2 make a progression: there the gram itself
  is periodic. Of the pairs in the band two kinds are enough: both are the last of their progressions, or the
  later one is the first of its own. (If the gram at the run's start is periodic and that period breaks inside
  the run's match, it breaks one lag later too, and both breaks end a progression. If it does not break inside the
  match, the second copy lies in another progression, and its gram starts that one: otherwise the whole run would have
  the smaller period.) So a long periodic stretch gives pairs in proportion to its length, not to its square.
* *Extension.* Pairs of one document go by lag and place; a table keeps for each lag how far it is covered,
  and a pair inside is dropped, so a diagonal is walked once. Each walk ends in the longest match around its pair.

Defined results: a null, empty or blank text has no words and no runs. Words are compared whole, as bytes. Rows that
repeat are judged each on its own; an empty table gives an empty one; extra columns pass through, columns named
like a result are replaced. Memory follows the words of a batch piece, or of its longest document.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlake.llm.frames import cleared

#: Fewest words of a run.
LEAST = 12
#: Words handled together; a longer document stands alone.
WORDS = 1 << 18

_RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_RUN_ARROW = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]))


def _named(names: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams that join the one at each place of ``at`` with the one ``step`` words on, and the places
    where such a gram repeats. A name of -1 is a gram that does not repeat."""
    at = at[at + step < len(names)]
    follow = names[at + step]
    at, follow = at[follow >= 0], follow[follow >= 0]
    out = np.full(len(names), -1, np.int64)
    if not len(at):
        return out, at
    key = names[at] * np.int64(len(names) + 1) + follow
    _, number, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[number] > 1
    at = at[again]
    out[at] = number[again]
    return out, at


def _pairs(names: np.ndarray, at: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the pairs of equal ``k``-grams with lags from ``low`` to ``high`` - 1 that runs need."""
    order = np.lexsort((at, names[at]))
    place, name = at[order], names[at][order]
    near = (name[1:] == name[:-1]) & (place[1:] - place[:-1] <= k // 2)
    last = np.append(~near, True)
    first = np.append(True, ~near)
    found = [(place[:-1][near], (place[1:] - place[:-1])[near])] if low <= k // 2 else []

    def within(early: np.ndarray, late: np.ndarray) -> None:
        """Pairs of an occurrence of ``early`` and a later one of ``late`` in the band."""
        width = np.int64(place.max() + 2 * high + 2)
        e_key, l_key = name[early] * width + place[early], name[late] * width + place[late]
        # the same name only: a lag never reaches into the next name's range
        a, b = np.searchsorted(e_key, l_key - (high - 1)), np.searchsorted(e_key, l_key - low, "right")
        size = np.maximum(b - a, 0)
        which = np.repeat(np.arange(len(late)), size)
        e = early[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)]
        l = late[which]
        same = name[e] == name[l]
        found.append((place[e[same]], place[l[same]] - place[e[same]]))

    if len(place):
        within(np.flatnonzero(last), np.flatnonzero(last))
        within(np.arange(len(place)), np.flatnonzero(first))
    where, lag = (np.concatenate([f[i] for f in found]) for i in (0, 1)) if found else (place[:0], place[:0])
    return where, lag


def _match(ids: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in [low, high) whose words equal those ``lag`` further on."""
    high -= lag
    a = b = at
    size = 32
    while b < high:
        same = ids[b:min(b + size, high)] == ids[b + lag:min(b + size, high) + lag]
        if not same.all():
            b += int(np.argmin(same))
            break
        b += len(same)
        size *= 2
    size = 32
    while a > low:
        same = ids[max(a - size, low):a] == ids[max(a - size, low) + lag:a + lag]
        if not same.all():
            a -= int(np.argmin(same[::-1]))
            break
        a -= len(same)
        size *= 2
    return a, b


def runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Per document the runs (start, length, period) by start, then period. ``ids`` number the words, equal numbers
    only for equal words of the same document; ``bounds`` are the documents' ends, from 0 on."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in bounds[1:]]
    n = int(np.diff(bounds).max(initial=0))
    if n < least or least < 2:
        return out
    # places whose word repeats in its document
    where = np.arange(len(ids))
    names = np.full(len(ids), -1, np.int64)
    again = np.bincount(ids)[ids] > 1
    names[again] = ids[again]
    where = where[again]
    size = 1
    k = least // 2
    # names of k-grams from those of powers of two
    powers = {1: (names, where)}
    while size * 2 <= k:
        names, where = _named(names, where, size)
        size *= 2
        powers[size] = (names, where)
    grams, at, covered = *powers[size], size
    for power in sorted((p for p in powers if p & k and p != size), reverse=True):
        # the gram so far is followed by one of `power` words
        grams, at = _joined(grams, at, powers[power][0], covered)
        covered += power
    seeds, low, high = [], 1, least
    while len(at) and low * 2 <= n:
        seeds.append(_pairs(grams, at, k, low, high))
        if high == least:  # from here on the grams are as long as the least lag
            grams, at = _joined(grams, at, grams, k)
            k *= 2
            if k < least:
                rest = np.full(len(ids), -1, np.int64)
                rest[powers[1][1]] = powers[1][0][powers[1][1]]
                grams, at = _joined(grams, at, rest, k)
                k += 1
        else:
            grams, at = _joined(grams, at, grams, k)
            k *= 2
        low, high = k, 2 * k
    if not seeds:
        return out
    place, lag = (np.concatenate([s[i] for s in seeds]) for i in (0, 1))
    doc = np.searchsorted(bounds, place, "right") - 1
    ok = place + lag < bounds[doc + 1]
    place, lag, doc = place[ok], lag[ok], doc[ok]
    order = np.lexsort((place, lag, doc))
    place, lag, doc = place[order], lag[order], doc[order]
    # a pair right behind another of its lag lies on the same stretch
    fresh = np.ones(len(place), bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] - place[:-1] > 1) | (doc[1:] != doc[:-1])
    best: dict[tuple[int, int], int] = {}
    furthest: dict[tuple[int, int], int] = {}
    for p, q, d in zip(place[fresh].tolist(), lag[fresh].tolist(), doc[fresh].tolist()):
        if furthest.get((d, q), -1) > p:
            continue
        a, b = _match(ids, p, q, int(bounds[d]), int(bounds[d + 1]))
        furthest[d, q] = b
        if b + q - a >= max(least, 2 * q):
            span = (a, b + q)
            if q < best.get(span, q + 1):  # a multiple of the period covers the same stretch
                best[span] = q
    for (a, b), q in best.items():
        d = int(np.searchsorted(bounds, a, "right")) - 1
        out[d].append((a - int(bounds[d]), b - a, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _joined(names: np.ndarray, at: np.ndarray, follow: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_named``, the second gram taken from other names."""
    at = at[at + step < len(names)]
    then = follow[at + step]
    at, then = at[then >= 0], then[then >= 0]
    out = np.full(len(names), -1, np.int64)
    if not len(at):
        return out, at
    _, number, times = np.unique(names[at] * np.int64(int(follow.max()) + 1) + then, return_inverse=True, return_counts=True)
    again = times[number] > 1
    at = at[again]
    out[at] = number[again]
    return out, at


def numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, all their numbers in turn (a document's words have numbers of their own), and the bounds."""
    fresh_number = count().__next__
    words, ids, bounds = [], [], [0]
    for text in texts:
        split = text.split()  # of bytes: at space and \\t \\n \\v \\f \\r only
        number: dict[bytes, int] = defaultdict(fresh_number)
        ids.append(np.fromiter(map(number.__getitem__, split), np.int64, len(split)))
        words.append(split)
        bounds.append(bounds[-1] + len(split))
    return words, np.concatenate(ids) if ids else np.zeros(0, np.int64), np.array(bounds, np.int64)


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: all but those of a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _pieces(texts: list[bytes]):
    """Runs of rows with about ``WORDS`` words at most (a word and its blank are two bytes at least)."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > 4 * WORDS:
            yield lo, k
            lo, size = k, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def find(docs: DataFrame, *, text: str = "text", least: int = LEAST, drop_text: bool = False) -> DataFrame:
    """``docs`` plus ``runs`` (start and length in words, period; by start, then period) and ``collapsed``: the words
    without those that only repeat a run's first period, joined by one space."""
    added = ("runs", "collapsed")
    docs = cleared(docs, *added)
    at, keep = docs.columns.index(text), [k for k, c in enumerate(docs.columns) if not (drop_text and c == text)]

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(at).cast(pa.binary())]
            for lo, hi in _pieces(texts):
                words, ids, bounds = numbered(texts[lo:hi])
                found = runs(ids, bounds, least)
                short = []
                for split, own in zip(words, found):
                    if own:
                        stay = kept(len(split), own)
                        split = [w for w, s in zip(split, stay.tolist()) if s]
                    short.append(b" ".join(split))
                listed = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in found]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in keep), pa.array(listed, _RUN_ARROW),
                     pa.array(short, pa.binary()).cast(pa.string())], names=[*(batch.schema.names[k] for k in keep), *added])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in keep), T.StructField("runs", T.ArrayType(_RUN, False)),
                                              T.StructField("collapsed", T.StringType())]))
