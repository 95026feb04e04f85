"""Runs of repeating words in whole texts, found by a suffix automaton whose link tree is kept as a link-cut tree.

Each word is appended to a suffix automaton. The suffix links from the state of the whole text so far to the root hold all
its suffixes, the longest first, and every state knows where its words last ended before: paths of states with the same last
end hang together in splay trees. Appending a word recolours the path to the root (the *access* of a link-cut tree) and
meets these segments one by one. A segment with last end `j` whose longest suffix has L words says that the texts up to `j`
and up to the current word agree in just L words, so L + d words with period d = distance of the two ends stand here; from
d <= L on they hold a square. d is their smallest period, since a smaller one would have ended the segment later, and no
word before them keeps it, since L is the whole agreement. Each word of a run repeats the finding with the same start, so
the last one gives the whole run. Recolouring costs the logarithm of the words per word, on the mean.

Only stretches of words that lie in a window of words found twice in the text can hold a run; the automaton is built for
those. The window is short enough that a run and a word that would extend it are always inside.
"""

import hashlib
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from holdfast.llm.common import map_texts


def runs_of(words: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of at least `least` words and `times` periods, by start and period."""
    # Automaton: state 1 is the root, 0 is none.
    after, link, longest = [{}, {}], [0, 0], [0, 0]
    # Splay trees of the paths: `up` leads to the parent inside a tree, from its root to the state above the path.
    up, left, right, last_end = [0, 0], [0, 0], [0, 0], [0, 0]
    whole, found = 1, {}

    def new_state(words_of_longest: int, arcs: dict[int, int], suffix: int) -> int:
        after.append(arcs)
        link.append(suffix)
        longest.append(words_of_longest)
        up.append(0)
        left.append(0)
        right.append(0)
        last_end.append(0)
        return len(link) - 1

    def rotate(x: int) -> None:
        """x takes the place of its parent; the root of a tree holds the last end of all of it."""
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = right[x]
            left[y], right[x] = inner, y
        else:
            inner = left[x]
            right[y], left[x] = inner, y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            last_end[x] = last_end[y]

    def splay(x: int) -> None:
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and left[z] == y:
                rotate(y if left[y] == x else x)
            elif z and right[z] == y:
                rotate(y if right[y] == x else x)
            rotate(x)

    for now, word in enumerate(words, 1):
        state, at = new_state(longest[whole] + 1, {}, 1), whole
        while at and word not in after[at]:
            after[at][word] = state
            at = link[at]
        if at:
            target = after[at][word]
            if longest[at] + 1 < longest[target]:
                # The shorter words of the target become a state of their own, just above it on its path.
                split = new_state(longest[at] + 1, after[target].copy(), link[target])
                while at and after[at].get(word) == target:
                    after[at][word] = split
                    at = link[at]
                splay(target)
                if left[target]:
                    left[split] = left[target]
                    up[left[split]] = split
                left[target], up[split], link[target] = split, target, split
                target = split
            link[state] = target
        up[state], whole = link[state], state
        # Access: the path's segments, the deepest first, become one path that ends here.
        below, at = state, link[state]
        while at:
            splay(at)
            before, rest, common = last_end[at], right[at], longest[at]
            if rest:
                last_end[rest] = before
            right[at] = below
            if before:
                period = now - before
                if common >= (times - 1) * period and common + period >= least:
                    found[now - common - period, period] = now
            below, at = at, up[at]
        last_end[below] = now
    return sorted((start, end - start, period) for (start, period), end in found.items())


def repeated_stretches(words: np.ndarray, window: int) -> list[tuple[int, int]]:
    """First word and end of the stretches whose words all lie in windows found twice; `window` is a power of two.

    Windows are compared by hash; a chance meeting makes a stretch longer, never shorter.
    """
    hashes, width = words.astype(np.uint64), 1
    while width < window:
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
        hashes = (mixed ^ mixed >> np.uint64(29))[:-width] * np.uint64(0xBF58476D1CE4E5B9) + hashes[width:]
        width *= 2
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(len(words) + 1, np.int32)
    for places in (order[1:][same], order[:-1][same]):
        part = np.zeros(len(words) + 1, np.int32)
        part[places] = 1
        twice |= part
    # Each window covers its words: steps up where it begins and down where it ends.
    steps = twice.copy()
    steps[window:] -= twice[:len(twice) - window]
    edges = np.diff(np.concatenate([[0], (np.cumsum(steps[:-1]) > 0).astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist()))


def periodic_runs_of(words: list[bytes], least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs of a text's words: those of its repeated stretches."""
    # A run repeats least * (times - 1) / times words or more, whatever its period.
    window = 1 << (least * (times - 1) // times).bit_length() - 1
    if len(words) < least or len(set(words)) + window > len(words):
        return []
    numbers: dict[bytes, int] = {}
    coded = [numbers.setdefault(w, len(numbers)) for w in words]
    out = []
    for first, end in repeated_stretches(np.array(coded), window):
        if end - first >= least:
            out += [(first + start, length, period) for start, length, period in runs_of(coded[first:end], least, times)]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods; ties go to the smaller start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def periodic_runs(
    docs: DataFrame, least: int = 24, times: int = 3, spans: bool = False, collapsed: bool = False, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Runs of each whole text: stretches of words that repeat with a smallest period, at least `least` words and `times`
    periods long, which no neighbouring word extends.

    n_runs; start (words from 0), length, period and exponent_milli (1000 * length / period, rounded down) of the run with
    most periods, null without a run; runs_sha256 of all runs as lines `start,length,period`; collapsed_sha256 of the words
    that stay when each run keeps its first period only, joined by one space. spans=True adds the runs as arrays `starts`,
    `lengths`, `periods`, collapsed=True the text that stays.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D. Null and empty texts have no words, no runs and the digests of
    nothing. A text is worked on as a whole; the automaton takes some 700 bytes for each word of a repeated stretch.
    Each row is treated alone, whatever its key: repeated rows and null keys come back as often, an empty table gives no rows.
    Other columns are not read, whatever their names.
    """
    if times < 2 or least < 2 * times:
        raise ValueError("a run has at least two periods and its least length at least two words a period")

    def work(texts: list[bytes]) -> list[list]:
        columns: list[list] = [[] for _ in range(7 + 3 * spans + collapsed)]
        for data in texts:
            words = data.split()
            runs = periodic_runs_of(words, least, times)
            best = strongest(runs)
            lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            rest = b" ".join(collapse(words, runs))
            row = [len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                   hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()]
            if spans:
                row += [[run[i] for run in runs] for i in range(3)]
            if collapsed:
                row.append(rest.decode("utf-8", "replace"))
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        return columns

    added = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    if spans:
        added += ", starts array<long>, lengths array<long>, periods array<long>"
    return map_texts(docs, [key], added + (", collapsed string" if collapsed else ""), work, text)
