r"""Metric trees by the anchors hierarchy, and nearest entries for all points of a tree at once.

Points are whole vectors of several spaces (here: part positions), given as one array sorted by
space. All spaces take their steps together, as arrays.

Anchors. The first anchor of a set is its first point. The point farthest from its own anchor
becomes the next one; it takes over every point that is nearer to it, and by the triangle
inequality only points more than half the distance between both anchors away from their own
can be. A set of n points gets about sqrt(n) anchors, fewer when all points are anchors.
Middle-out: the anchors of a set are joined from the middle upwards, always the two whose common ball is
smallest, and the points of each anchor are a set that is treated the same way downwards,
until a set is small or all its points are equal. Each ball caches the number and the sum
of its points, its centroid and its radius around that.

Entries. The root of a space has all entries of its codebook as candidates. A ball keeps those
whose distance to its centroid, less its radius, is not above the smallest such distance plus
the radius; its children inherit what is left. A ball with one candidate left is owned by it,
with all its points. Points of a leaf with several are compared with these in full, in whole
numbers, ties to the lower number. The bounds are lowered by more than the error of their floats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidewell.llm.common import ragged

LEAF = 12
_SLACK = 1e-9


@dataclass
class Trees:
    """One tree per space. A node holds the points `low` to `high`; `left` is -1 for a leaf; roots come last, one per space."""

    points: np.ndarray  # in the order of the leaves
    origin: np.ndarray  # row of each point in the given array
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    radius: np.ndarray
    roots: np.ndarray

    def packed(self) -> list[bytes]:
        return [narrow(getattr(self, name)) for name in _FIELDS]

    @classmethod
    def unpacked(cls, parts: list[bytes], dim: int) -> "Trees":
        given = dict(zip(_FIELDS, map(wide, parts)))
        for name in ("points", "sums"):
            given[name] = given[name].reshape(-1, dim)
        return cls(**given)


_FIELDS = ("points", "origin", "low", "high", "left", "right", "sums", "radius", "roots")


def narrow(values: np.ndarray) -> bytes:
    """The bytes of an array in the smallest type that holds it, and a letter for that type."""
    kind = "d" if values.dtype.kind == "f" else next(k for k in "hiq" if np.abs(values).max(initial=0) <= np.iinfo(k).max)
    return kind.encode() + values.astype("<" + kind).tobytes()


def wide(data: bytes) -> np.ndarray:
    kind = data[:1].decode()
    return np.frombuffer(data, dtype="<" + kind, offset=1).astype(np.float64 if kind == "d" else np.int64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.sqrt(np.einsum("...i,...i->...", d, d))


def _first_of_largest(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per segment the largest value and the first place that holds it."""
    most = np.maximum.reduceat(values, begins)
    at = np.flatnonzero(values == np.repeat(most, lengths))
    segment = np.searchsorted(begins, at, side="right") - 1
    return most, at[np.concatenate([[True], segment[1:] != segment[:-1]])]


def _anchors(x: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor (counted from 0 in its set) of each point, and the number of anchors per set. `x` is sorted by set."""
    sets, wanted = len(begins), np.ceil(np.sqrt(lengths)).astype(np.int64).clip(2)
    of_set = np.repeat(np.arange(sets), lengths)
    centres = np.zeros((sets, int(wanted.max()), x.shape[1]))
    centres[:, 0] = x[begins]
    own, far = np.zeros(len(x), dtype=np.int64), _distance(x, centres[of_set, 0])
    count = np.ones(sets, dtype=np.int64)
    for k in range(1, centres.shape[1]):
        most, at = _first_of_largest(far, begins, lengths)
        grows = (most > 0) & (wanted > k)
        if not grows.any():
            break
        centres[:, k] = x[at]
        count += grows
        between = _distance(centres[:, :k], centres[:, k:k + 1])
        between[~grows] = np.inf
        asked = np.flatnonzero(2 * far > between[of_set, own] * (1 - _SLACK))
        d = _distance(x[asked], centres[of_set[asked], k])
        nearer = d < far[asked]
        own[asked[nearer]], far[asked[nearer]] = k, d[nearer]
    return own, count


def _joined(members: np.ndarray, begins: np.ndarray, count: np.ndarray, sums: list, sizes: list, radius: list, left: list, right: list) -> np.ndarray:
    """Joins the nodes of each set, always the pair of smallest common ball; gives each set's last node.

    `members`: nodes of all sets, sorted by set. New nodes are appended to the lists.
    """
    sets, most = len(begins), int(count.max())
    node = np.full((sets, most), -1, dtype=np.int64)
    row, place = np.repeat(np.arange(sets), count), np.arange(len(members)) - np.repeat(begins, count)
    node[row, place] = members
    total, n, r = np.zeros((sets, most, len(sums[0]))), np.ones((sets, most)), np.zeros((sets, most))
    total[row, place], n[row, place], r[row, place] = np.array(sums)[members], np.array(sizes)[members], np.array(radius)[members]

    def common(who: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Radius of the ball of entry i of each set together with each other entry."""
        ti, ni, ri = total[who, i][:, None], n[who, i][:, None], r[who, i][:, None]
        tj, nj, rj = total[who], n[who], r[who]
        apart = _distance(ti / ni[..., None], tj / nj[..., None])
        ball = np.maximum(apart * nj / (ni + nj) + ri, apart * ni / (ni + nj) + rj)
        ball[node[who] < 0] = np.inf
        ball[np.arange(len(who)), i] = np.inf
        return ball

    everyone = np.arange(sets)
    balls = np.stack([common(everyone, np.full(sets, i)) for i in range(most)], axis=1)
    balls[node < 0] = np.inf
    left_over = count.copy()
    while (left_over > 1).any():
        who = np.flatnonzero(left_over > 1)
        i, j = np.divmod(balls[who].reshape(len(who), -1).argmin(axis=1), most)
        ball = balls[who, i, j]
        first = len(left)
        left.extend(node[who, i].tolist())
        right.extend(node[who, j].tolist())
        total[who, i] += total[who, j]
        n[who, i] += n[who, j]
        r[who, i] = ball
        sums.extend(total[who, i])
        sizes.extend(n[who, i].astype(np.int64).tolist())
        radius.extend(ball.tolist())
        node[who, i] = np.arange(first, first + len(who))
        node[who, j] = -1
        left_over[who] -= 1
        balls[who, j, :] = balls[who, :, j] = np.inf
        new = common(who, i)
        balls[who, i, :], balls[who, :, i] = new, new
    return node.max(axis=1)


def build(x: np.ndarray, lengths: np.ndarray) -> Trees:
    """Trees over the whole points `x`, sorted by space; `lengths`: points per space, at least one each."""
    lengths = np.asarray(lengths, dtype=np.int64)
    sums, sizes, radius, left, right = [], [], [], [], []
    leaf_points: dict[int, np.ndarray] = {}
    pending = [(np.arange(len(x)), lengths, None)]  # points by set, their numbers, and whose places the sets' roots take
    tops, swaps = None, {}
    while pending:
        rows, sizes_of, owners = pending.pop()
        at = x[rows].astype(np.float64)
        begins = np.cumsum(sizes_of) - sizes_of
        own, count = _anchors(at, begins, sizes_of)
        of_set = np.repeat(np.arange(len(sizes_of)), sizes_of)
        slot = (np.cumsum(count) - count)[of_set] + own
        order = np.argsort(slot, kind="stable")
        per_slot = np.bincount(slot, minlength=int(count.sum()))
        starts = np.cumsum(per_slot) - per_slot
        ordered = at[order]
        slot_sums = np.add.reduceat(ordered, starts, axis=0)
        reach = np.maximum.reduceat(_distance(ordered, np.repeat(slot_sums / per_slot[:, None], per_slot, axis=0)), starts)
        first = len(left)
        names = np.arange(first, first + len(per_slot))
        sums.extend(slot_sums)
        sizes.extend(per_slot.tolist())
        radius.extend(reach.tolist())
        left.extend([-1] * len(names))
        right.extend([-1] * len(names))
        splits = (per_slot > LEAF) & (reach > 0) & (np.repeat(count, count) > 1)
        points = np.split(rows[order], starts[1:])
        for i in np.flatnonzero(~splits).tolist():
            leaf_points[int(names[i])] = points[i]
        roots = _joined(names, np.cumsum(count) - count, count, sums, sizes, radius, left, right)
        if owners is None:
            tops = roots
        else:
            swaps.update(zip(owners.tolist(), roots.tolist()))
        deeper = np.flatnonzero(splits)
        if len(deeper):
            pending.append((np.concatenate([points[i] for i in deeper.tolist()]), per_slot[deeper], names[deeper]))
    return _laid_out(x, tops, swaps, left, right, leaf_points)


def _laid_out(x: np.ndarray, tops: np.ndarray, swaps: dict, left: list, right: list, leaf_points: dict) -> Trees:
    """Nodes of a subtree one after the other, points in the order of the leaves, exact sums and radii."""
    low, high, kids, order, held = [], [], [], [], 0

    def real(node: int) -> int:
        while node in swaps:
            node = swaps[node]
        return node

    roots = []
    for top in tops.tolist():
        done: dict[int, int] = {}
        stack = [(real(top), False)]
        while stack:
            node, seen = stack.pop()
            if left[node] < 0:
                rows = leaf_points[node]
                low.append(held)
                held += len(rows)
                high.append(held)
                order.append(rows)
                kids.append((-1, -1))
                done[node] = len(low) - 1
            elif seen:
                a, b = done[real(left[node])], done[real(right[node])]
                low.append(low[a])
                high.append(high[b])
                kids.append((a, b))
                done[node] = len(low) - 1
            else:
                stack += [(node, True), (real(right[node]), False), (real(left[node]), False)]
        roots.append(len(low) - 1)
    low, high, origin = np.array(low), np.array(high), np.concatenate(order)
    points, n = x[origin], high - low
    running = np.concatenate([np.zeros((1, x.shape[1]), dtype=np.int64), np.cumsum(points, axis=0)])
    sums = running[high] - running[low]
    radius = np.zeros(len(low))
    for begin in range(0, len(low), 4096):
        part = slice(begin, begin + 4096)
        at = ragged(low[part], n[part])
        far = _distance(points[at].astype(np.float64), np.repeat(sums[part] / n[part, None], n[part], axis=0))
        radius[part] = np.maximum.reduceat(far, np.cumsum(n[part]) - n[part])
    kids = np.array(kids)
    return Trees(points, origin, low, high, kids[:, 0], kids[:, 1], sums, radius, np.array(roots))


def nearest(trees: Trees, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all points in the order of the trees, and the owned balls: nodes, their entries, and which points lie in none.

    `books`: spaces x entries x dim, whole numbers; an entry's number is its place.
    """
    spaces, entries = books.shape[:2]
    flat = books.reshape(spaces * entries, -1)
    as_float = flat.astype(np.float64)
    codes = np.zeros(len(trees.points), dtype=np.int64)
    alone = np.zeros(len(codes), dtype=bool)
    balls, owners = [], []
    node = trees.roots
    lists = np.arange(spaces * entries)  # candidates of each node, one after the other, ascending
    count = np.full(spaces, entries, dtype=np.int64)
    while len(node):
        begins = np.cumsum(count) - count
        centre = trees.sums[node] / (trees.high - trees.low)[node, None]
        d = _distance(np.repeat(centre, count, axis=0), as_float[lists])
        reach = np.minimum.reduceat(d, begins) + 2 * trees.radius[node]
        keep = d * (1 - _SLACK) <= np.repeat(reach * (1 + _SLACK) + _SLACK, count)
        lists, count = lists[keep], np.add.reduceat(keep.astype(np.int64), begins)
        begins = np.cumsum(count) - count
        owned = count == 1
        if owned.any():
            who, entry = node[owned], lists[begins[owned]] % entries
            balls.append(who)
            owners.append(entry)
            n = trees.high[who] - trees.low[who]
            codes[ragged(trees.low[who], n)] = np.repeat(entry, n)
        leaf = ~owned & (trees.left[node] < 0)
        if leaf.any():
            who, each = node[leaf], count[leaf]
            n = trees.high[who] - trees.low[who]
            at = ragged(trees.low[who], n)
            alone[at] = True
            per_point = np.repeat(each, n)
            candidates = lists[ragged(np.repeat(begins[leaf], n), per_point)]
            apart = np.repeat(trees.points[at], per_point, axis=0) - flat[candidates]
            far = np.einsum("ij,ij->i", apart, apart)
            _, first = _first_of_largest(-far, np.cumsum(per_point) - per_point, per_point)
            codes[at] = candidates[first] % entries
        goes = np.flatnonzero(~owned & (trees.left[node] >= 0))
        inherited = ragged(begins[goes], count[goes])
        node, lists = np.concatenate([trees.left[node[goes]], trees.right[node[goes]]]), np.tile(lists[inherited], 2)
        count = np.tile(count[goes], 2)
    none = np.zeros(0, dtype=np.int64)
    return codes, np.concatenate([none, *balls]), np.concatenate([none, *owners]), alone
