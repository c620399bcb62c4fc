"""Main text of web pages with a tree-structured graphical model.

Every node of a page's block tree is content or not. Node potentials come from what a block looks like, edge potentials
couple a child with its parent, and elements that name their purpose (menu, footer, form, ...) are held to it. Messages
run from the leaves to the root and back, for all pages of a batch at once, one depth after another; they give each
block's marginal. The potentials are smoothed counts from labelled pages: pages that mark their article, whose nodes are
content inside it and not outside.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import id_sample, staged
from bitexture.llm.html_tree import GROUPS, ROLE_WORDS, Node, parse

TRAINING_PAGES = 2_000  # bound of the labelled sample
PRIOR = 20.0  # pages that the starting counts stand for
CLAMP = 1_000.0
MOST_EVIDENCE = 6.0  # that one node's looks can give
KINDS = ["page", "other", "main", "box", "block"]

# Chances that a child is content, for a parent that is not and for one that is, before training.
START_EDGES = {"page": (0.3, 0.9), "other": (1e-6, 0.5), "main": (0.5, 1 - 1e-5), "box": (0.1, 0.97), "block": (0.01, 0.99)}
# Chances that a node with this look is content, before training.
START_LOOKS = {
    "main": 0.9, "in:p": 0.8, "in:heading": 0.7, "in:blockquote": 0.8, "in:pre": 0.8, "in:li": 0.4, "in:td": 0.5,
    "words:0": 0.2, "words:1": 0.3, "words:2": 0.5, "words:3": 0.75, "words:4": 0.9,
    "links:0": 0.6, "links:1": 0.5, "links:2": 0.2, "links:3": 0.05, "stop": 0.7, "no stop": 0.3, "commas": 0.75,
}


def kind_of(node: Node) -> str:
    if node.parent < 0:
        return "page"
    if node.role == "main":
        return "main"
    if node.role:
        return "other"
    return "block" if node.tag in GROUPS and node.tag not in ("td", "th", "tr", "table") else "box"


def looks(node: Node, parent: Node | None) -> list[str]:
    if node.tag:
        return ["main"] if node.role == "main" else []
    words = len(node.text.split())
    share = node.linked / max(1, sum(map(len, node.pieces)))
    found = [f"in:{GROUPS.get(parent.tag, 'box')}" if parent else "in:box"]
    found.append(f"words:{sum(words >= n for n in (3, 7, 15, 30))}")
    found.append(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
    found.append("stop" if node.text[-1:] in tuple(".!?…。\"'”»)") else "no stop")
    if "," in node.text:
        found.append("commas")
    return found


def true_labels(nodes: list[Node]) -> list[int] | None:
    """Content or not, per node of a page that marks its article; None for a page that does not."""
    if not any(n.role == "main" and n.marked for n in nodes):
        return None
    labels = []
    for node in nodes:
        inside = node.parent >= 0 and labels[node.parent] == 1
        labels.append(int((node.role == "main" and node.marked) or (inside and node.role in ("", "main"))))
    return labels


def count_labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of looks by label and of child labels by parent kind and label."""
    counts: Counter[tuple[str, int]] = Counter()
    for batch in batches:
        for page in batch["html"]:
            nodes = parse(page)
            labels = true_labels(nodes)
            if labels is None:
                continue
            for node, label in zip(nodes, labels):
                parent = nodes[node.parent] if node.parent >= 0 else None
                counts.update((look, label) for look in looks(node, parent))
                if parent is not None and node.role not in ROLE_WORDS:
                    counts[f"edge:{kind_of(parent)}:{labels[node.parent]}", label] += 1
    yield pd.DataFrame([(k, label, n) for (k, label), n in counts.items()], columns=["feature", "label", "n"])


@dataclass(frozen=True)
class TreeModel:
    looks: dict[str, float]  # log odds that a look speaks for content
    edges: np.ndarray  # kind of parent, its label, label of the child: log chance

    @classmethod
    def from_counts(cls, rows: list[tuple[str, int, int]]) -> TreeModel:
        counts = Counter({(feature, label): float(n) for feature, label, n in rows})
        looks_log = {}
        features = {f for f, _ in counts if not f.startswith("edge:")} | set(START_LOOKS)
        groups = {}
        for f in features:
            groups.setdefault(f.split(":")[0] if ":" in f else "stop" if "stop" in f else f, []).append(f)
        for members in groups.values():
            totals = [sum(counts[f, y] for f in members) for y in (0, 1)]
            for f in members:
                start = START_LOOKS.get(f, 0.5)
                # What was seen is worth at most as many nodes as the start, so that few layouts do not decide alone.
                seen = [counts[f, y] / totals[y] if totals[y] else 0.0 for y in (0, 1)]
                trained = sum(seen) > 0
                share = seen[1] / sum(seen) if trained else start
                share = (PRIOR * start + PRIOR * share * trained) / (PRIOR + PRIOR * trained)
                share = min(max(share, 0.02), 0.98)
                looks_log[f] = float(np.log(share / (1 - share)))
        edges = np.zeros((len(KINDS), 2, 2))
        for i, kind in enumerate(KINDS):
            for parent in (0, 1):
                seen = [counts[f"edge:{kind}:{parent}", y] for y in (0, 1)]
                start = START_EDGES[kind][parent]
                share = (PRIOR * start + seen[1]) / (PRIOR + sum(seen))
                edges[i, parent] = np.log([max(1 - share, 1e-7), max(share, 1e-7)])
        return cls(looks_log, edges)

    def marginals(self, pages: list[list[Node]]) -> list[np.ndarray]:
        """Per page the chance of every node to be content: sum-product over all trees side by side."""
        sizes = [len(p) for p in pages]
        starts = np.cumsum([0, *sizes])
        parent = np.concatenate([[n.parent + s if n.parent >= 0 else -1 for n in p] for p, s in zip(pages, starts)])
        depth = np.concatenate([[n.depth for n in p] for p in pages])
        kind = np.concatenate([[KINDS.index(kind_of(n)) for n in p] for p in pages])
        own = np.zeros((len(parent), 2))
        own[:, 1] = np.concatenate([[self._evidence(n, p) for n in p] for p in pages])
        by_depth = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
        levels = [by_depth[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

        up, sent = np.zeros_like(own), np.zeros_like(own)
        for level in levels[:0:-1]:
            edge = self.edges[kind[parent[level]]]
            sent[level] = np.logaddexp.reduce(edge + (own[level] + up[level])[:, None, :], axis=2)
            np.add.at(up, parent[level], sent[level])
        down = np.zeros_like(own)
        down[levels[0]] = np.log([0.9, 0.1])
        for level in levels[1:]:
            above = own[parent[level]] + up[parent[level]] + down[parent[level]] - sent[level]
            edge = self.edges[kind[parent[level]]]
            down[level] = np.logaddexp.reduce(edge + above[:, :, None], axis=1)
        belief = own + up + down
        chance = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))
        return [chance[a:b] for a, b in zip(starts[:-1], starts[1:])]

    def _evidence(self, node: Node, page: list[Node]) -> float:
        if node.tag and node.role:
            if node.role == "main":
                return CLAMP if node.marked else MOST_EVIDENCE
            return -CLAMP
        parent = page[node.parent] if node.parent >= 0 else None
        total = sum(self.looks.get(look, 0.0) for look in looks(node, parent))
        return float(np.clip(total, -MOST_EVIDENCE, MOST_EVIDENCE))

    def texts(self, pages: list[str | None]) -> list[str]:
        trees = [parse(page) for page in pages]
        if not trees:
            return []
        return [
            " ".join(n.text for n, p in zip(tree, chances) if n.text and p >= 0.5)
            for tree, chances in zip(trees, self.marginals(trees))
        ]


def train_tree_model(pages: DataFrame, id_col: str, html_col: str, at_most: int = TRAINING_PAGES) -> TreeModel:
    """Counts over at most ``at_most`` pages, the first by a hash of their id; those without a marked article add nothing."""
    sample = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    chosen = staged(id_sample(sample, "id", at_most), "training-pages")
    sample = sample.join(F.broadcast(chosen), "id", "left_semi").select("html")
    counts = sample.mapInPandas(count_labelled, "feature string, label int, n bigint")
    rows = counts.groupBy("feature", "label").agg(F.sum("n").alias("n")).orderBy("feature", "label").collect()
    return TreeModel.from_counts([(r.feature, r.label, r.n) for r in rows])  # as many rows as looks and edges


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = (), model: TreeModel | None = None
) -> DataFrame:
    """One row per input row: id, the columns in ``keep``, ``text``, ``n_chars``.

    The text is what the model takes for the article: character references decoded, white space inside a block one blank,
    blocks in page order joined by a blank; empty if there is none. A missing or empty page gives an empty text. Rows are
    independent, so repeated rows and missing ids change nothing but the training sample, which takes distinct ids. Other
    columns play no part, and an empty table gives an empty table.
    """
    model = train_tree_model(pages, id_col, html_col) if model is None else model

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        texts = []
        for start in range(0, len(column), 200):
            texts += model.texts(column.iloc[start : start + 200].tolist())
        return pd.Series(texts, dtype=object)

    columns = [F.col(id_col), *(F.col(c) for c in keep)]
    found = pages.select(*columns, main_text(F.col(html_col)).alias("text"))
    return found.select("*", F.length("text").cast("long").alias("n_chars"))
