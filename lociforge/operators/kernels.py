"""Sequential algorithms as small functions, run per group by ``applyInPandas``; every input is put in order first."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache
from itertools import groupby

import numpy as np

MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 2, -2, -3, -1


def nearest_clusters(pairs: Iterable[tuple[int, int]], margin: int = 50) -> list[tuple[int, int, int]]:
    """Greedy clustering of (start, end): each joins the nearest cluster of which both ends are less than ``margin`` away, or founds one.

    A cluster keeps its founder's ends.  Returns (start, end, members).  Founders are kept by squares of ``margin``, so a pair asks those of nine squares, not all.
    """
    found: list[list[int]] = []
    squares: dict[tuple[int, int], list[int]] = {}
    for start, end in pairs:
        x, y = start // margin, end // margin
        best = None
        for square in [(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)] if margin > 0 else ():
            for i in squares.get(square, ()):
                c = found[i]
                if abs(c[0] - start) < margin and abs(c[1] - end) < margin:
                    near = abs(c[0] - start) + abs(c[1] - end), i
                    best = near if best is None or near < best else best
        if best is not None:
            found[best[1]][2] += 1
        else:
            squares.setdefault((x, y), []).append(len(found))
            found.append([start, end, 1])
    return [tuple(c) for c in found]


def interval_clusters(rows: Iterable[dict], margin: int = 10) -> list[dict]:
    """Greedy clustering of breakpoint pairs: the first cluster with equal directions whose two intervals both come within ``margin``.

    A cluster's intervals grow to the union of its members'.
    """
    found: list[dict] = []
    for r in rows:
        home = next(
            (
                c for c in found
                if (c["dir0"], c["dir1"]) == (r["dir0"], r["dir1"])
                and all(c[f"lo{k}"] <= r[f"hi{k}"] + margin and r[f"lo{k}"] <= c[f"hi{k}"] + margin for k in (0, 1))
            ),
            None,
        )
        if home is None:
            found.append(r | {"n": 1, "p0": [r["pos0"]], "p1": [r["pos1"]], "gaps": [r["overlap_gap"]]})
            continue
        home["n"] += 1
        for k in (0, 1):
            home[f"lo{k}"], home[f"hi{k}"] = min(home[f"lo{k}"], r[f"lo{k}"]), max(home[f"hi{k}"], r[f"hi{k}"])
        home["p0"].append(r["pos0"])
        home["p1"].append(r["pos1"])
        home["gaps"].append(r["overlap_gap"])
    return found


def upper_median(values: Sequence[float]) -> float:
    return sorted(values)[len(values) // 2]


@lru_cache(maxsize=4096)
def align(ref: str, query: str) -> tuple[int, list[tuple[str, int]]]:
    """Global alignment with affine gaps, case ignored: score and run-length operations (M, I: only in the query, D: only in the reference).

    The first base of a gap costs ``GAP_OPEN + GAP_EXTEND``; a gap opens only from a match state; ties go to M, then D, then I.
    """
    a, b = ref.upper(), query.upper()
    n, m = len(a), len(b)
    if not n and not m:
        return 0, []
    low, first, more = -(10**9), GAP_OPEN + GAP_EXTEND, GAP_EXTEND
    # rows of the three states' scores: M, D (gap in the query), I (gap in the reference); backs as one number per cell and state
    sm, sd, si = [0] + [low] * m, [low] * (m + 1), [low] + [GAP_OPEN + GAP_EXTEND * j for j in range(1, m + 1)]
    backs = [[(0, 0, 2 if j > 1 else 0) for j in range(m + 1)]]
    for i in range(1, n + 1):
        tm, td, ti = [low] * (m + 1), [low] * (m + 1), [low] * (m + 1)
        td[0] = GAP_OPEN + GAP_EXTEND * i
        row = [(0, 1 if i > 1 else 0, 0)]
        base = a[i - 1]
        for j in range(1, m + 1):
            x, y, z = sm[j - 1], sd[j - 1], si[j - 1]
            k = 0 if x >= y and x >= z else 1 if y >= z else 2
            tm[j] = (x, y, z)[k] + (MATCH if base == b[j - 1] else MISMATCH)
            opened, longer = sm[j] + first, sd[j] + more
            td[j], d = (opened, 0) if opened >= longer else (longer, 1)
            opened, longer = tm[j - 1] + first, ti[j - 1] + more
            ti[j], e = (opened, 0) if opened >= longer else (longer, 2)
            row.append((k, d, e))
        backs.append(row)
        sm, sd, si = tm, td, ti
    ends = (sm[m], sd[m], si[m])
    best = max(ends)
    state, i, j, ops = ends.index(best), n, m, []
    while i or j:
        ops.append("MDI"[state])
        state, i, j = backs[i][j][state], i - (state != 2), j - (state != 1)
    runs: list[tuple[str, int]] = []
    for op in reversed(ops):
        runs = [*runs[:-1], (op, runs[-1][1] + 1)] if runs and runs[-1][0] == op else [*runs, (op, 1)]
    return best, runs


#: Pairs aligned side by side, bounded by the bytes of their back pointers; less work than that of few cells is done one by one.
_BYTES, _FEW = 1 << 22, 64


def align_many(refs: Sequence[str], queries: Sequence[str]) -> list[tuple[int, list[tuple[str, int]]]]:
    """``align`` of each pair: equal pairs once, those of equal lengths side by side, a step per diagonal of their tables."""
    out: dict[tuple[str, str], tuple[int, list[tuple[str, int]]]] = {}
    shapes: dict[tuple[int, int], list[tuple[str, str]]] = {}
    for pair in dict.fromkeys(zip(refs, queries, strict=True)):
        a, b = pair
        if a == b and a:
            out[pair] = MATCH * len(a), [("M", len(a))]
        else:
            shapes.setdefault((len(a), len(b)), []).append(pair)
    for (n, m), pairs in shapes.items():
        if len(pairs) * min(n, m) < _FEW or any(not a.isascii() or not b.isascii() for a, b in pairs):
            out.update((pair, align(*pair)) for pair in pairs)
            continue
        size = max(1, _BYTES // ((n + 1) * (n + m + 1)))
        for i in range(0, len(pairs), size):
            out.update(zip(pairs[i : i + size], _aligned(pairs[i : i + size], n, m), strict=True))
    return [out[pair] for pair in zip(refs, queries, strict=True)]


def _aligned(pairs: list[tuple[str, str]], n: int, m: int) -> list[tuple[int, list[tuple[str, int]]]]:
    """``align`` of pairs of lengths ``n`` and ``m``: a diagonal's cells (by their place in the reference) and all pairs in one array."""
    a = np.ascontiguousarray(np.frombuffer("".join(r for r, _ in pairs).upper().encode(), np.uint8).reshape(len(pairs), n).T)
    b = np.ascontiguousarray(np.frombuffer("".join(q for _, q in pairs).upper().encode(), np.uint8).reshape(len(pairs), m).T[::-1])
    kind, wide = np.int16 if n + m < 1_000 else np.int32, len(pairs)
    low, first, more = kind(-8_000 if kind is np.int16 else -(10**9)), kind(GAP_OPEN + GAP_EXTEND), kind(GAP_EXTEND)
    before, last, now = (np.full((3, n + 1, wide), low, kind) for _ in range(3))  # states M, D, I of three diagonals
    last[0, 0] = 0
    backs = np.zeros((n + m + 1, n + 1, wide), np.uint8)  # k + 4 d + 16 e, as in ``align``
    for s in range(1, n + m + 1):
        lo, hi = max(1, s - m), min(n, s - 1) + 1
        if lo < hi:
            x, y, z = before[:, lo - 1 : hi - 1]
            best = np.maximum(np.maximum(x, y), z)
            other = x < best
            back = other.view(np.uint8) + (other & (y < best)).view(np.uint8)
            best += kind(MISMATCH)
            best += (a[lo - 1 : hi - 1] == b[m - s + lo : m - s + hi]) * kind(MATCH - MISMATCH)
            now[0, lo:hi] = best
            opened, longer = last[0, lo - 1 : hi - 1] + first, last[1, lo - 1 : hi - 1] + more
            np.maximum(opened, longer, out=now[1, lo:hi])
            back |= (longer > opened).view(np.uint8) << 2
            opened, longer = last[0, lo:hi] + first, last[2, lo:hi] + more
            np.maximum(opened, longer, out=now[2, lo:hi])
            back |= (longer > opened).view(np.uint8) << 5
            backs[s, lo:hi] = back
        gap = GAP_OPEN + GAP_EXTEND * s
        if s <= n:
            now[:, s], now[1, s], backs[s, s] = low, gap, 4 if s > 1 else 0
        if s <= m:
            now[:, 0], now[2, 0], backs[s, 0] = low, gap, 32 if s > 1 else 0
        before, last, now = last, now, before
    sm, sd, si = last[:, n]
    best = np.maximum(np.maximum(sm, sd), si)
    state = np.where(sm == best, 0, np.where(sd == best, 1, 2))
    i, j, each, steps = np.full(wide, n), np.full(wide, m), np.arange(wide), []
    while (open_ := (i > 0) | (j > 0)).any():
        steps.append(np.where(open_, state, 3).astype(np.uint8))
        back = (backs[i + j, i, each] >> (2 * np.minimum(state, 2)).astype(np.uint8)) & 3
        i, j, state = i - (open_ & (state != 2)), j - (open_ & (state != 1)), np.where(open_, back, state)
    ops = np.array([ord(c) for c in "MDI-"], np.uint8)[np.array(steps)[::-1].T]
    text, known = ops.tobytes().decode(), {}
    out = []
    for at, score in zip(range(0, len(text), len(steps)), best.tolist(), strict=True):
        path = text[at : at + len(steps)]
        if path not in known:
            known[path] = [(op, sum(1 for _ in part)) for op, part in groupby(path.lstrip("-"))]
        out.append((score, known[path]))
    return out


def polish(template: str, reads: Sequence[str], min_coverage: int = 1) -> str:
    """One round: reads vote per template column; columns with more gaps than bases go, insertions of half the reads or more come in."""
    counted = Counter(reads)
    return _voted(template, counted, [align(template, read)[1] for read in counted], min_coverage)


def _voted(template: str, reads: Mapping[str, int], paths: Sequence[list[tuple[str, int]]], min_coverage: int) -> str:
    """``polish`` of distinct reads with their numbers and alignments."""
    total = sum(reads.values())
    votes: list[dict[str, int]] = [{} for _ in template]
    gaps = [0] * len(template)
    inserted: list[list[str]] = [[] for _ in range(len(template) + 1)]
    for (read, times), path in zip(reads.items(), paths, strict=True):
        at = q = 0
        for op, n in path:
            if op == "M":
                for vote, base in zip(votes[at : at + n], read[q : q + n], strict=True):
                    vote[base] = vote.get(base, 0) + times
                at, q = at + n, q + n
            elif op == "D":
                for k in range(n):
                    gaps[at + k] += times
                at += n
            else:
                inserted[at] += [read[q : q + n]] * times
                q += n
    out = []
    for i in range(len(template) + 1):
        extra = inserted[i]
        if extra and len(extra) >= -(-total // 2):
            size = upper_median([len(x) for x in extra])
            out += [_most(Counter(x[k] for x in extra if k < len(x))) for k in range(size)]
        if i < len(template):
            bases = sum(votes[i].values())
            if bases >= gaps[i] and bases >= min_coverage:
                out.append(_most(votes[i]))
    return "".join(out)


def _most(votes: Mapping[str, int]) -> str:
    """The base with most votes, in the order A, C, G, T on ties; other letters do not count."""
    if len(votes) == 1 and (only := next(iter(votes))) in "ACGT":
        return only
    return max("ACGT", key=lambda base: (votes.get(base, 0), -"ACGT".index(base)))


def consensus(reads: Sequence[str], rounds: int = 5, min_coverage: int = 1) -> str:
    """The longest read, polished until it stays or returns to an earlier form."""
    return consensus_many([reads], rounds, min_coverage)[0]


def consensus_many(groups: Sequence[Sequence[str]], rounds: int = 5, min_coverage: int = 1) -> list[str]:
    """``consensus`` of each group, their alignments of a round side by side and equal reads of a group once."""
    counted = [Counter(reads) for reads in groups]
    templates = [max(reversed(reads), key=len) if reads else "" for reads in groups]
    seen = [{template} for template in templates]
    left = list(range(len(groups)))
    for _ in range(rounds):
        pairs = [(templates[g], read) for g in left for read in counted[g]]
        paths = iter(align_many([t for t, _ in pairs], [r for _, r in pairs]))
        open_ = []
        for g in left:
            templates[g] = _voted(templates[g], counted[g], [next(paths)[1] for _ in counted[g]], min_coverage)
            if templates[g] not in seen[g]:
                seen[g].add(templates[g])
                open_.append(g)
        left = open_
    return templates


def bracketed(left: str, right: str, left_name: str, right_name: str, inserted: str = "") -> str:
    """``LEFT(gene)|(gene)RIGHT``, or with the inserted bases in square brackets between."""
    return f"{left}({left_name})[{inserted}]({right_name}){right}" if inserted else f"{left}({left_name})|({right_name}){right}"
