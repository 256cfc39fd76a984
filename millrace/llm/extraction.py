"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks.

Features are the tags of a block's ancestors, telling words of their class, id and role, and
simple measures of the block's text. The field has a weight per feature, one per pair of
neighbouring labels and one for a first label; it is trained on labelled pages by gradient ascent
of the log-likelihood (forward-backward) and decoded by Viterbi. Blocks that it labels as main
text are joined in page order by one space.

Defined cases: a null or empty page, or one without a block of main text, gives an empty text.
Equal pages give equal texts. Character references are decoded, white space inside a block becomes
one space. Scripts, styles, templates, frames and drawings are no text; formulas are, and so is what
stands in for a missing script or player. Elements that are not closed end with their parent, also
those without text; a slash closes a drawing or formula. Pages of any length are read whole. Other columns are not touched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.llm.labelled_pages import MAIN, labelled_pages
from millrace.llm.page_blocks import FEATURES, Block, blocks_of

TRAINING_PAGES = 400
ROUNDS = 40


@dataclass
class Field:
    """Scores of the label "main" against "other", by feature and by neighbouring labels."""

    weights: np.ndarray  # one per feature, for main; other has none
    follow: np.ndarray  # [label, next label]
    first: np.ndarray  # of the first label
    known: dict[int, float] = field(default_factory=dict)

    def score(self, features: int) -> float:
        value = self.known.get(features)
        if value is None:
            if len(self.known) > 100_000:
                self.known.clear()
            value = float(self.weights[_bits(features)].sum())
            self.known[features] = value
        return value


def _bits(features: int) -> list[int]:
    return [k for k in range(len(FEATURES)) if features >> k & 1]


def _gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, follow: np.ndarray, first: np.ndarray):
    """Gradient of one page's log-likelihood, by the expected labels of forward-backward."""
    n = len(y)
    node = np.stack([np.zeros(n), x @ weights], axis=1)
    ahead, back = np.empty((n, 2)), np.zeros((n, 2))
    ahead[0] = node[0] + first
    for t in range(1, n):
        ahead[t] = node[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + follow, axis=0)
    for t in range(n - 2, -1, -1):
        back[t] = np.logaddexp.reduce(follow + (node[t + 1] + back[t + 1])[None, :], axis=1)
    total = np.logaddexp.reduce(ahead[-1])
    chance = np.exp(ahead + back - total)
    pairs = ahead[:-1, :, None] + follow + (node[1:] + back[1:])[:, None, :] - total
    on_follow = -np.exp(pairs).sum(axis=0)
    np.add.at(on_follow, (y[:-1], y[1:]), 1)
    on_first = -chance[0]
    on_first[y[0]] += 1
    return x.T @ (y - chance[:, 1]), on_follow, on_first


def train(pages: list[str], rounds: int = ROUNDS, rate: float = 0.5, penalty: float = 1e-3) -> Field:
    """Fit on labelled pages by gradient ascent with steps by accumulated squares."""
    data = []
    for page in pages:
        blocks = blocks_of(page)
        if blocks:
            x = np.zeros((len(blocks), len(FEATURES)))
            for i, block in enumerate(blocks):
                x[i, _bits(block.features)] = 1
            data.append((x, np.array([int(b.label == MAIN) for b in blocks])))
    values = [np.zeros(len(FEATURES)), np.zeros((2, 2)), np.zeros(2)]
    squares = [np.full_like(v, 1e-6) for v in values]
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        order = rng.permutation(len(data))
        for lo in range(0, len(order), 50):
            chosen = order[lo : lo + 50]
            sums = [-penalty * len(chosen) * v for v in values]
            for k in chosen:
                for total, part in zip(sums, _gradient(*data[k], *values)):
                    total += part
            for v, s, g in zip(values, squares, sums):
                g /= len(chosen)
                s += g * g
                v += rate * g / np.sqrt(s)
    return Field(*values)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages(TRAINING_PAGES))


def viterbi(model: Field, blocks: list[Block]) -> list[bool]:
    """Whether each block is main text, on the best path of labels."""
    if not blocks:
        return []
    (oo, om), (mo, mm) = model.follow.tolist()
    other, main = model.first.tolist()
    main += model.score(blocks[0].features)
    from_main: list[tuple[bool, bool]] = []
    for block in blocks[1:]:
        s = model.score(block.features)
        came = (main + mo > other + oo, main + mm > other + om)
        other, main = (
            main + mo if came[0] else other + oo,
            (main + mm if came[1] else other + om) + s,
        )
        from_main.append(came)
    label = main > other
    path = [label]
    for came in reversed(from_main):
        label = came[label]
        path.append(label)
    return path[::-1]


def main_text(model: Field, html: str | None) -> str:
    blocks = blocks_of(html)
    return " ".join(b.text for b, keep in zip(blocks, viterbi(model, blocks)) if keep)


def extractor(model: Field) -> Callable[[Column], Column]:
    """A function of an HTML column that gives its main text."""

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(model, page.as_py()) for page in pages], pa.string())

    return extract
