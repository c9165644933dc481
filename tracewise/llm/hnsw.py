"""Near-duplicate vectors through navigable small-world graphs.

Vectors of a label are dealt to shards, and each shard gets a hierarchical graph. Every vector queries every shard of
its label. An audit of each graph searches for vectors turned away from some of its own until they are only just similar
enough to be links, and beams are widened until all of those are found; another compares the links of some queries of each
shard with a full scan. A query whose whole beam is links is widened further, and vectors that no path in the graph
reaches are scanned. Links are verified by cosine, count for both ends whichever found them, and components are their
union.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import connected_components, give_back, materialise
from tracewise.llm.vectors import usable

SHARD = 8192  #: about as many distinct vectors in a shard
DEGREE = 12  #: links of a node on upper layers; twice as many on the lowest
BEAM = 32
AUDIT = 64  #: vectors of a graph, and queries of a shard, that an audit looks at
TOGETHER = 512
ROUND_BYTES = 64 << 20  #: of graphs that are sent to all tasks at once
SLACK = 1e-5  #: by which similarities in single precision may fall short; pairs are verified in double


def _diverse(near: np.ndarray, ids: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Of candidates sorted by similarity `near`, those that are nearer to their node than to any one taken before."""
    taken = np.full((len(ids), most), -1, np.int64)
    count = np.zeros(len(ids), np.int64)
    vec = x[np.maximum(ids, 0)]
    other = np.einsum("ncd,nmd->ncm", vec, vec)
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        rival = np.where(chosen, other[:, c, :], -2).max(axis=1)
        ok = (ids[:, c] >= 0) & (count < most) & (near[:, c] > rival)
        chosen[:, c] = ok
        taken[ok, count[ok]] = ids[ok, c]
        count += ok
    return taken


@dataclass
class Graph:
    """x: unit vectors. layers: (members, links) from the lowest; links holds member numbers, -1 where there is none."""

    x: np.ndarray
    layers: list[np.ndarray]
    tops: list[np.ndarray]

    def pack(self) -> tuple:
        """Layers in as few bytes as will do; the vectors are left out."""
        small = np.int16 if len(self.x) < 1 << 15 else np.int32
        return [(m.astype(small), links[m].astype(small)) for m, links in zip(self.tops, self.layers, strict=True)]

    @staticmethod
    def unpack(x: np.ndarray, packed: list[tuple[np.ndarray, np.ndarray]]) -> Graph:
        g = Graph(x, [], [])
        for members, links in packed:
            layer = np.full((len(x), links.shape[1]), -1, np.int32)
            layer[members] = links
            g.layers.append(layer)
            g.tops.append(members.astype(np.int64))
        return g

    def lost(self) -> np.ndarray:
        """Numbers of the vectors that no path of the lowest layer reaches from where searches enter it."""
        seen = np.zeros(len(self.x), bool)
        front = self.tops[min(1, len(self.tops) - 1)] if len(self.tops) > 1 else self.tops[0][:1]
        while len(front):
            seen[front] = True
            near = self.layers[0][front]
            front = np.unique(near[near >= 0])
            front = front[~seen[front]]
        return np.flatnonzero(~seen)

    @staticmethod
    def build(x: np.ndarray, seed: int = 3) -> Graph:
        x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int)
        g = Graph(x, [], [])
        for depth in range(int(level.max(initial=0)), -1, -1):
            members = np.flatnonzero(level >= depth)
            links = np.full((n, DEGREE * (2 if depth == 0 else 1)), -1, np.int32)
            at = 0
            while at < len(members):
                new = members[at : at + min(TOGETHER, max(64, at))]
                near, ids = np.full((len(new), 0), -2, np.float32), np.full((len(new), 0), -1, np.int64)
                if at:
                    start = g.enter(x[new]) if g.layers else np.repeat(members[:1], len(new))[:, None]
                    start = np.where(np.isin(start, members[:at]), start, members[0])
                    near, ids = _walk(x, links, x[new], start, BEAM)
                own = x[new] @ x[new].T
                np.fill_diagonal(own, -2)
                # Of a batch, each node sees those before it, as if they had come one by one.
                own[np.triu_indices(len(new))] = -2
                top = np.argsort(-own, axis=1)[:, :BEAM]
                own = np.take_along_axis(own, top, axis=1)
                near = np.concatenate([near, own], axis=1)
                ids = np.concatenate([ids, np.where(own > -2, new[top], -1)], axis=1)
                order = np.argsort(-near, axis=1, kind="stable")[:, :BEAM]
                taken = _diverse(np.take_along_axis(near, order, 1), np.take_along_axis(ids, order, 1), x, DEGREE)
                links[new, :DEGREE] = taken
                to, who = taken[taken >= 0], np.repeat(new, (taken >= 0).sum(axis=1))
                _link_back(x, links, to, who)
                at += len(new)
            g.layers.insert(0, links)
            g.tops.insert(0, members)
        return g

    def enter(self, q: np.ndarray) -> np.ndarray:
        """Where the layer below those built is entered."""
        start = np.repeat(self.tops[-1][:1], len(q))[:, None]
        for links in reversed(self.layers):
            _, start = _walk(self.x, links, q, start, 4)
        return np.where(start[:, :1] >= 0, start[:, :1], self.tops[-1][0])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, numbers) of about the `beam` nearest, nearest first; -1 where there are fewer."""
        upper = Graph(self.x, self.layers[1:], self.tops[1:])
        start = upper.enter(q) if upper.layers else np.repeat(self.tops[0][:1], len(q))[:, None]
        return _walk(self.x, self.layers[0], q, start, beam)


def _link_back(x: np.ndarray, links: np.ndarray, to: np.ndarray, who: np.ndarray) -> None:
    """Gives `to` links to `who`; a node with too many keeps a diverse choice of the nearest."""
    order = np.argsort(to, kind="stable")
    to, who = to[order], who[order]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    most = links.shape[1]
    for at in range(0, len(nodes), 256):
        part, f, c = nodes[at : at + 256], first[at : at + 256], count[at : at + 256]
        ids = np.full((len(part), most + int(c.max())), -1, np.int64)
        ids[:, :most] = links[part]
        ids[np.repeat(np.arange(len(part)), c), most + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] = who[f[0] : f[-1] + c[-1]]
        near = np.where(ids >= 0, np.einsum("nd,ncd->nc", x[part], x[np.maximum(ids, 0)]), -2)
        best = np.argsort(-near, axis=1, kind="stable")[:, : 2 * most]
        near, ids = np.take_along_axis(near, best, 1), np.take_along_axis(ids, best, 1)
        full = (ids >= 0).sum(axis=1) > most
        links[part[~full]] = ids[~full][:, :most]
        if full.any():
            links[part[full]] = _diverse(near[full], ids[full], x, most)


def _walk(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries in step."""
    n = len(q)
    seen = np.zeros((n, len(x)), bool)
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), -2, np.float32)
    ids[:, 0] = start[:, 0]
    near[:, 0] = np.einsum("nd,nd->n", q, x[start[:, 0]])
    seen[np.arange(n), start[:, 0]] = True
    done = np.zeros((n, beam), bool)
    live = np.arange(n)
    while len(live):
        open_ = (ids[live] >= 0) & ~done[live]
        has = open_.any(axis=1)
        live, open_ = live[has], open_[has]
        if not len(live):
            break
        at = open_.argmax(axis=1)
        done[live, at] = True
        more = links[ids[live, at]].astype(np.int64)
        fresh = (more >= 0) & ~seen[live[:, None], np.maximum(more, 0)]
        r, c = np.nonzero(fresh)
        seen[live[r], more[r, c]] = True
        sim = np.where(fresh, np.einsum("nd,nmd->nm", q[live], x[np.maximum(more, 0)]), -2)
        all_near = np.concatenate([near[live], sim], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[live] = np.take_along_axis(all_near, order, 1)
        ids[live] = np.where(near[live] > -2, np.take_along_axis(np.concatenate([ids[live], more], axis=1), order, 1), -1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros_like(fresh)], axis=1), order, 1)
    return near, ids


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def scan_from(n: int) -> int:
    """The beam from which a search would cost more than a scan of n vectors, a product of matrices; graphs of few vectors are
    searched too."""
    return max(2 * BEAM, n // 64)


def audited_beam(g: Graph, least: float, beam: int = BEAM) -> int:
    """The narrowest doubled beam that finds each of AUDIT of the graph's vectors from a place at cosine `least` of it,
    unless what it finds instead is links alone, for which searches widen their beams anyway."""
    n = len(g.x)
    at = np.unique(np.linspace(0, n - 1, min(AUDIT, n)).astype(int))
    v = g.x[at].astype(np.float64)
    away = np.random.default_rng(n).standard_normal(v.shape)
    away -= (away * v).sum(axis=1, keepdims=True) * v
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    probes = (least * v + np.sqrt(max(0.0, 1 - least**2)) * away).astype(np.float32)
    lost = np.isin(at, g.lost())
    while beam < scan_from(n):
        near, ids = g.search(probes, beam)
        if ((ids == at[:, None]).any(axis=1) | (near[:, -1] >= least - SLACK) | lost).all():
            break
        beam *= 2
    return beam


def links_of(g: Graph, raw: np.ndarray, q: np.ndarray, least: float, beam: int = BEAM) -> list[np.ndarray]:
    """Sorted numbers of the vectors within cosine `least` of each query. raw and q: the given vectors; beam: what the
    graph's own audit allows."""
    raw, q, uq, n = raw.astype(np.float64), q.astype(np.float64), unit(q), len(raw)
    norm, norm_q = np.linalg.norm(raw, axis=1), np.linalg.norm(q, axis=1)
    slack, lost = least - SLACK, g.lost()

    def verified(i: int, ids: np.ndarray) -> np.ndarray:
        dots = raw @ q[i] if len(ids) > n // 8 else None
        dots = (raw[ids] * q[i]).sum(axis=1) if dots is None else dots[ids]
        return ids[dots / (norm[ids] * norm_q[i]) >= least]

    def scan(rows: np.ndarray) -> list[np.ndarray]:
        return [np.flatnonzero(s >= slack) for at in range(0, len(rows), TOGETHER) for s in uq[rows[at : at + TOGETHER]] @ g.x.T]

    def found(rows: np.ndarray, beam: int) -> dict[int, np.ndarray]:
        """Beams full of links are doubled; one as wide as a good part of the shard would cost more than a scan."""
        out: dict[int, np.ndarray] = {}
        while len(rows) and beam < scan_from(n):
            full = []
            for at in range(0, len(rows), TOGETHER):
                part = rows[at : at + TOGETHER]
                apart = uq[part] @ g.x[lost].T
                for i, s, x, other in zip(part.tolist(), *g.search(uq[part], beam), apart, strict=True):
                    if s[-1] >= slack:
                        full.append(i)
                    else:
                        out[i] = np.union1d(x[s >= slack], lost[other >= slack]).astype(np.int64)
            rows = np.array(full, int)
            beam *= 2
        return out | dict(zip(rows.tolist(), scan(rows), strict=True))

    audit = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    truth = dict(zip(audit.tolist(), map(set, scan(audit)), strict=True))
    while beam < scan_from(n) and any(truth[i] - set(x.tolist()) for i, x in found(audit, beam).items()):
        beam *= 2
    every = found(np.arange(len(q)), beam)
    return [verified(i, every[i]) for i in range(len(q))]


def _built(least: float):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        raw = np.stack(part["embedding"].to_numpy())
        g = Graph.build(unit(raw))
        blob = pickle.dumps((raw, g.pack(), audited_beam(g, least), part["vec_id"].to_numpy(), part["copies"].to_numpy()))
        return pd.DataFrame({"dim": [key[0]], "label": [key[1]], "shard": [key[2]], "graph": [blob]})

    return run


def components(linked: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """(first, other) numbers that span each set of rows and columns that links join. Columns are numbered after the rows,
    or as they are if both are the same vectors."""
    rows, columns = linked.shape
    out, seen, seen_column = [], np.zeros(rows, bool), np.zeros(columns, bool)
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        if seen[start]:
            continue
        front = np.array([start])
        seen[start] = True
        while len(front):
            hit = np.flatnonzero(linked[front].any(axis=0) & ~seen_column)
            seen_column[hit] = True
            out += [(start, int(j) + (0 if same else rows)) for j in hit]
            front = hit[~seen[hit]] if same else np.flatnonzero(linked[:, hit].any(axis=1) & ~seen)
            seen[front] = True
            if not same:
                out += [(start, int(i)) for i in front]
    return [(a, b) for a, b in out if a != b]


def compared(blobs: list[bytes], least: float) -> pd.DataFrame:
    """Of one shard, or of two that query each other: each vector's number of links, and edges that span its links. A link
    counts for both ends, whichever of them found it."""
    both = [pickle.loads(blob) for blob in blobs]
    (raw, packed, beam, ids, copies), (raw2, packed2, beam2, ids2, copies2) = both[0], both[-1]
    same = len(both) == 1
    linked = np.zeros((len(ids), len(ids2)), bool)
    for i, hit in enumerate(links_of(Graph.unpack(unit(raw2), packed2), raw2, raw, least, beam2)):
        linked[i, hit] = True
    if same:
        linked |= linked.T
        np.fill_diagonal(linked, False)
    else:
        for i, hit in enumerate(links_of(Graph.unpack(unit(raw), packed), raw, raw2, least, beam)):
            linked[hit, i] = True
    total, total2 = np.zeros(len(ids)), np.zeros(len(ids2))
    for at in range(0, len(ids), TOGETHER):
        part = linked[at : at + TOGETHER].astype(np.float64)
        total[at : at + TOGETHER] = part @ copies2
        total2 += copies[at : at + TOGETHER] @ part
    out = [(ids[i].item(), None, int(total[i])) for i in np.flatnonzero(total)]
    out += [] if same else [(ids2[i].item(), None, int(total2[i])) for i in np.flatnonzero(total2)]
    every = ids if same else np.concatenate([ids, ids2])
    out += [(every[a].item(), every[b].item(), 0) for a, b in components(linked, same)]
    return pd.DataFrame(out, columns=["a", "b", "links"]).astype({"a": "Int64", "b": "Int64", "links": "Int64"})


def meets(shard: int, sent: int) -> bool:
    """Whether a shard's own task compares it with a shard that was sent to it; of two different ones, one task does."""
    return shard == sent or (shard < sent) == ((shard + sent) % 2 == 0)


def _compared(least: float, sent: list[tuple[int, int, int, bytes]]):
    """Graphs -> links among each of them and those of its label that were sent."""
    by_label: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for dim, label, shard, blob in sent:
        by_label.setdefault((dim, label), []).append((shard, blob))

    @give_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, label, shard, blob in zip(b["dim"], b["label"], b["shard"], b["graph"], strict=True):
                for other, graph in by_label.get((dim, label), ()):
                    if meets(shard, other):
                        yield compared([blob] if shard == other else [blob, graph], least)

    return run


def _rounds(graphs: DataFrame) -> list[DataFrame]:
    """The graphs in lots of ROUND_BYTES at most, or one graph. Only their names and sizes are listed."""
    of = F.concat_ws("|", "dim", "label", "shard")
    lots: list[list[str]] = []
    size = ROUND_BYTES
    for name, n in graphs.select(of, F.length("graph")).orderBy("dim", "label", "shard").collect():
        if size + n > ROUND_BYTES:
            lots.append([])
            size = 0
        lots[-1].append(name)
        size += n
    return [graphs.where(of.isin(lot)) for lot in lots]


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    vectors: vec_id, embedding, label; other columns, whatever their names, are not read. Linked: equal labels, not null,
    equal lengths and a cosine of `least` or more. Vectors that are null, empty, zero or hold null or non-finite
    components, and those without a label, link with nothing. Equal vectors of a label are one node with a count of ids.
    Repeated rows are one vector and get the same result each; of an id with several usable vectors the first by label,
    length and components counts for all its rows. Null ids stay, with no component. An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    good = good.groupBy("vec_id").agg(F.min(F.struct("label", F.size("embedding").alias("dim"), "embedding")).alias("v")).select("vec_id", "v.*")
    good = materialise(good, "vectors")
    classes = materialise(
        good.groupBy("dim", "label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "classes"
    )
    shards = classes.groupBy("dim", "label").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    nodes = classes.join(shards, ["dim", "label"]).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")))
    graphs = materialise(
        nodes.groupBy("dim", "label", "shard").applyInPandas(_built(least), "dim int, label int, shard long, graph binary"), "graphs"
    )
    # A graph holds its shard's vectors, so two graphs are all that two shards need to query each other. Graphs stay where
    # they are; in each round a bounded lot of them is sent to all tasks.
    found = [good.select(F.col("vec_id").alias("a"), F.col("vec_id").alias("b"), F.lit(0).cast("long").alias("links")).where(F.lit(False))]
    for lot in _rounds(graphs):
        sent = [(r["dim"], r["label"], r["shard"], bytes(r["graph"])) for r in lot.collect()]
        found.append(materialise(graphs.mapInPandas(_compared(least, sent), "a long, b long, links long"), "links"))
    found = reduce(DataFrame.unionByName, found)
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    own = classes.join(counts, F.col("vec_id") == F.col("a"), "left").select(
        "dim", "label", "embedding", F.col("vec_id").alias("rep"), (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("links")
    )
    # Most vectors have no link and are alone in their class; they need no join.
    of_id = good.join(own.where("links > 0"), ["dim", "label", "embedding"]).select("vec_id", "rep", "links")
    component = connected_components(found.where("b is not null").select("a", "b"))
    of_id = of_id.join(component, F.col("rep") == F.col("node"), "left").select("vec_id", "links", F.coalesce("component", "rep").alias("c"))
    return (
        rows.select("vec_id").join(of_id, "vec_id", "left")
        .select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
