"""Hierarchical navigable small-world graphs in flat neighbour arrays.

A graph is a list of layers, top first; a layer is the nodes it holds and an array with
one row of neighbours per node, filled up with -1. Points are inserted, and queries
answered, many at a time: each step widens the beams of a whole batch at once. Nearness
is the inner product; rows are expected to have one length (see `lift`).
"""

import numpy as np

LINKS = 16
BUILD_BEAM = 64
INSERT = 256
WIDTH = 4
LOW = np.float32(-np.inf)


def lift(vectors, radius):
    """Vectors of length `radius` with the same inner products with (query, 0)."""
    rest = np.maximum(radius**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0)
    return np.c_[vectors, np.sqrt(rest)].astype(np.float32)


def _near(points, queries, ids):
    return np.einsum("bmd,bd->bm", points[ids], queries)


def beam(points, links, place, entries, queries, size):
    """The `size` nearest nodes met per query: (ids, nearness), -1 where fewer.

    `place` maps a point to its row of `links`; `entries` are start nodes per query."""
    rows = np.arange(len(queries))
    seen = np.zeros((len(queries), len(points)), bool)
    ids = np.full((len(queries), size), -1)
    near = np.full((len(queries), size), LOW)
    spread = np.zeros((len(queries), size), bool)
    first = np.sort(entries[:, : min(size, entries.shape[1])], axis=1)
    first[:, 1:][first[:, 1:] == first[:, :-1]] = -1
    start = first.shape[1]
    ids[:, :start] = first
    near[:, :start] = np.where(first >= 0, _near(points, queries, first), LOW)
    r, c = np.nonzero(first >= 0)
    seen[rows[r], first[r, c]] = True
    while True:
        open_ = np.where(spread, LOW, near)
        width = min(WIDTH, size)
        pick = np.argpartition(-open_, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(open_, pick, axis=1)
        live = value.max(axis=1) > LOW
        if not live.any():
            return ids, near
        act = np.flatnonzero(live)
        pick, value = pick[act], value[act]
        chosen = np.where(value > LOW, np.take_along_axis(ids[act], pick, axis=1), -1)
        spread[act[:, None], pick] = True
        listed = links[np.where(chosen >= 0, place[chosen], 0)]
        found = np.where(chosen[:, :, None] >= 0, listed, -1).reshape(len(act), -1)
        found.sort(axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[act[:, None], found]
        some = np.flatnonzero(fresh.any(axis=0))
        found, fresh = found[:, some], fresh[:, some]
        if not len(some):
            continue
        r, c = np.nonzero(fresh)
        seen[act[r], found[r, c]] = True
        score = np.where(fresh, _near(points, queries[act], found), LOW)
        all_ids = np.concatenate([ids[act], np.where(fresh, found, -1)], axis=1)
        all_near = np.concatenate([near[act], score], axis=1)
        all_spread = np.concatenate([spread[act], ~fresh], axis=1)
        keep = np.argpartition(-all_near, size - 1, axis=1)[:, :size]
        ids[act] = np.take_along_axis(all_ids, keep, axis=1)
        near[act] = np.take_along_axis(all_near, keep, axis=1)
        spread[act] = np.take_along_axis(all_spread, keep, axis=1)


def diverse(points, owners, ids, near, most):
    """Up to `most` neighbours per owner: those nearer to it than to any kept before,
    then the nearest of the rest. `ids` holds -1 where there is none."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
    cross = np.einsum("bmd,bnd->bmn", points[ids], points[ids])
    kept = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        closest = np.where(kept, cross[:, j], LOW).max(axis=1)
        kept[:, j] = (ids[:, j] >= 0) & (near[:, j] > closest) & (kept.sum(axis=1) < most)
    rank = np.argsort(np.where(ids >= 0, np.where(kept, 0, 1), 2), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, rank, axis=1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _layer(points, nodes, most, above):
    """Neighbour array of one layer over `nodes`, entered through the layers `above`."""
    place = np.full(len(points), -1)
    place[nodes] = np.arange(len(nodes))
    links = np.full((len(nodes), most), -1)
    done = 0
    while done < len(nodes):
        new = nodes[done : done + min(INSERT, max(64, done))]
        own = points[new] @ points[new].T
        np.fill_diagonal(own, LOW)
        take = min(len(new), most + 1)
        peers = np.argpartition(-own, take - 1, axis=1)[:, :take]
        ids, near = new[peers], np.take_along_axis(own, peers, axis=1)
        ids = np.where(near > LOW, ids, -1)
        if done:
            entries = enter(points, above, points[new]) if above else np.repeat(nodes[:1][None], len(new), axis=0)
            entries = np.where(place[entries] < done, entries, -1)
            entries[:, 0] = np.where(entries.max(axis=1) < 0, nodes[0], entries[:, 0])
            old, old_near = beam(points, links[:done], place, entries, points[new], BUILD_BEAM)
            ids, near = np.concatenate([old, ids], axis=1), np.concatenate([old_near, near], axis=1)
        links[done : done + len(new)] = diverse(points, new, ids, near, most)
        # the other direction: every chosen neighbour lists the new node too, and thins out
        source = np.repeat(new, most)
        target = links[done : done + len(new)].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        if len(heads):
            wide = np.full((len(heads), most + count.max()), -1)
            wide[:, :most] = links[place[heads]]
            wide[np.repeat(np.arange(len(heads)), count), most + np.arange(len(target)) - np.repeat(first, count)] = source
            wide.sort(axis=1)
            wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
            for lo in range(0, len(heads), 512):
                part, own_heads = wide[lo : lo + 512], heads[lo : lo + 512]
                near = np.where(part >= 0, _near(points, points[own_heads], part), LOW)
                if part.shape[1] > 4 * most:
                    best = np.argpartition(-near, 4 * most - 1, axis=1)[:, : 4 * most]
                    part, near = np.take_along_axis(part, best, axis=1), np.take_along_axis(near, best, axis=1)
                links[place[own_heads]] = diverse(points, own_heads, part, near, most)
        done += len(new)
    return links


def enter(points, layers, queries):
    """A start node per query, by walking down `layers` from the top."""
    entries = np.repeat(layers[0][0][:1][None], len(queries), axis=0)
    for nodes, links in layers:
        place = np.full(len(points), -1)
        place[nodes] = np.arange(len(nodes))
        entries, near = beam(points, links, place, entries, queries, 8)
        entries = np.take_along_axis(entries, np.argsort(-near, axis=1), axis=1)
        entries = np.where(entries >= 0, entries, entries[:, :1])
    return entries


def build(points, seed=0):
    """Layers, top first, over all rows of `points`."""
    level = (-np.log(np.random.default_rng(seed).uniform(1e-12, 1, len(points))) / np.log(LINKS)).astype(int)
    order = np.argsort(-level, kind="stable")
    layers = []
    for height in range(min(level.max(), 4), -1, -1):
        nodes = order[level[order] >= height]
        layers.append((nodes, _layer(points, nodes, LINKS if height else 2 * LINKS, layers)))
    return layers


def search(points, layers, queries, size):
    """Per query the ids of `size` near points, in no order; -1 where there are fewer."""
    nodes, links = layers[-1]
    entries = enter(points, layers[:-1], queries) if len(layers) > 1 else np.repeat(nodes[:1][None], len(queries), axis=0)
    place = np.full(len(points), -1)
    place[nodes] = np.arange(len(nodes))
    return beam(points, links, place, entries, queries, min(size, len(points)))[0]
