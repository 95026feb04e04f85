"""Effects of features that are switched one after the other, on a sum of trees, without scoring the hybrid points.

A leaf holds the hybrid point during one stretch of the steps at most: from the step where the last feature that leads to it
by the row's own value is switched, to the step where the first one that leads to it by the background value is. So its value
is added to the feature that opens the stretch and taken from the one that closes it. Walking each tree once for a block of
rows and draws gives the same differences of margins as scoring every step.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Values of one block of rows: draws times steps times rows.
BLOCK_VALUES = 2**20


def parsed_trees(text: str, factor: float) -> list:
    """The trees of a model's `toDebugString`: a leaf is its value times weight and factor, a node (feature, test, left, right)."""
    lines = iter(text.splitlines())

    def node(line: str, scale: float):
        words = line.split()
        if words[0] == "Predict:":
            return float(words[1]) * scale
        # If (feature 3 <= 0.5)  or  If (feature 3 in {0.0,1.0})
        feature, relation, value = int(words[2]), words[3], words[4].rstrip(")")
        test = float(value) if relation == "<=" else np.array([float(v) for v in value.strip("{}").split(",")])
        left = node(next(lines), scale)
        next(lines)  # Else
        return feature, test, left, node(next(lines), scale)

    trees = []
    for line in lines:
        words = line.split()
        if words[:1] == ["Tree"]:
            trees.append(node(next(lines), factor * float(words[3].rstrip("):"))))
    return trees


def goes_left(values: np.ndarray, test) -> np.ndarray:
    return values <= test if isinstance(test, float) else np.isin(values, test)


def pair_effects(trees: list, x: np.ndarray, background: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """[row, base, pair, feature]: half the sum of a feature's effects in the order and in its reverse.

    x has a row per customer, orders the features in the order of switching, [row, base, pair, place].
    """
    rows, bases, pairs, width = orders.shape
    points, draws = rows * bases, 2 * pairs
    forward = np.empty(orders.shape, dtype=np.int32)
    np.put_along_axis(forward, orders, np.arange(1, width + 1, dtype=np.int32), axis=-1)
    ranks = np.concatenate([forward, width + 1 - forward], axis=2).reshape(points, draws, width)
    by_feature = np.ascontiguousarray(ranks.transpose(2, 0, 1))
    # What each step adds to the margin; step 0 is the background point and the last place holds stretches without an end.
    added = np.zeros(points * draws * (width + 2))
    place = (np.arange(points * draws) * (width + 2)).reshape(points, draws)

    def walk(node, at: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        if not len(at):
            return
        if not isinstance(node, tuple):
            held = first < end
            own = place[at][held]
            added[own + first[held]] += node
            added[own + end[held]] -= node
            return
        feature, test, left, right = node
        own_left = goes_left(x[:, feature], test)[at // bases]
        base_left = goes_left(background[:, feature], test)[at % bases]
        rank = by_feature[feature][at]
        for child, own, base in ((left, own_left, base_left), (right, ~own_left, ~base_left)):
            some = own | base
            # By the own value alone: from its switch on; by the background value alone: until then.
            since = np.where(base[some, None], 0, rank[some])
            until = np.where(own[some, None], width + 1, rank[some])
            walk(child, at[some], np.maximum(first[some], since), np.minimum(end[some], until))

    everywhere = np.arange(points)
    for tree in trees:
        walk(tree, everywhere, np.zeros((points, draws), dtype=np.int32), np.full((points, draws), width + 1, dtype=np.int32))
    effects = np.take_along_axis(added.reshape(points, draws, width + 2), ranks, axis=2)
    return ((effects[:, :pairs] + effects[:, pairs:]) / 2).reshape(rows, bases, pairs, width)


def summed_effects(trees: list, background: list[list[float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (customer_id, x, orders) sorted by customer to (customer_id, s, ss), the sums over pairs of effects and
    of their squares by base and feature. Rows with the same customer count as one, whose effects are theirs together."""
    base = np.array(background)
    bases, width = base.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last customer's key and effects, since the next rows may be its as well.
        kept = None
        kind = None

        def sums(keys: list, effects: np.ndarray) -> pa.RecordBatch:
            lists = [pa.array(list(v.sum(axis=2).reshape(len(keys), -1)), pa.list_(pa.float64())) for v in (effects, effects**2)]
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), *lists], names=["customer_id", "s", "ss"])

        for batch in batches:
            kind = batch.column(0).type
            if not batch.num_rows:
                continue
            pairs = len(batch.column(2)[0]) // bases
            block = max(1, BLOCK_VALUES // (2 * bases * pairs * (width + 2)))
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                keys = part.column(0).to_pylist()
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(keys), width)
                orders = part.column(2).flatten().flatten().to_numpy(zero_copy_only=False)
                effects = pair_effects(trees, x, base, orders.reshape(len(keys), pairs, bases, width).swapaxes(1, 2))
                starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1])]
                effects, keys = np.add.reduceat(effects, starts, axis=0), [keys[i] for i in starts]
                if kept is not None:
                    if kept[0] == keys[0]:
                        effects[0] += kept[1][0]
                    else:
                        yield sums([kept[0]], kept[1])
                if len(keys) > 1:
                    yield sums(keys[:-1], effects[:-1])
                kept = keys[-1], effects[-1:].copy()
        if kept is not None:
            yield sums([kept[0]], kept[1])

    return summed
