"""Main text of pages: a linear-chain conditional random field over DOM leaf blocks.

The field scores each block from its ancestor tags, names and text and each pair of
neighbouring labels; Viterbi decoding finds a page's best labelling. It is trained on
labelled pages by maximum likelihood with exact gradients from forward and backward sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.batches import per_slice
from lastmile.llm.html_blocks import FEATURES, blocks
from lastmile.llm.html_pages import labelled_pages

TRAINING_PAGES = 600
STEPS = 150
RATE = 0.08
L2 = 0.02


@dataclass
class ChainField:
    """Two labels (0: furniture, 1: article). ``weight`` scores label 1 of a block by its features."""

    weight: np.ndarray
    start: np.ndarray  # by label of the first block
    step: np.ndarray  # by labels of neighbours

    def decode(self, page: list[list[int]]) -> list[int]:
        """The labelling with the greatest score."""
        if not page:
            return []
        (a, b), ((aa, ab), (ba, bb)) = self.start.tolist(), self.step.tolist()
        back = []
        gain = [float(self.weight[f].sum()) for f in page]
        low, high = a, b + gain[0]
        for g in gain[1:]:
            to_low, to_high = (low + aa, high + ba), (low + ab, high + bb)
            back.append((to_low[1] > to_low[0], to_high[1] > to_high[0]))
            low, high = max(to_low), max(to_high) + g
        label = int(high > low)
        out = [label]
        for choice in reversed(back):
            label = int(choice[label])
            out.append(label)
        return out[::-1]

    @staticmethod
    def fit(pages: list[list[list[int]]], labels: list[list[int]], steps: int = STEPS) -> ChainField:
        """Adam on the penalised log-likelihood of all pages, padded to one length."""
        longest, count = max(map(len, pages)), len(pages)
        x = np.zeros((count, longest, len(FEATURES)), np.float32)
        y, real = np.zeros((count, longest), int), np.zeros((count, longest), bool)
        for i, (page, label) in enumerate(zip(pages, labels)):
            for j, f in enumerate(page):
                x[i, j, f] = 1
            y[i, : len(page)], real[i, : len(page)] = label, True
        flat = x.reshape(-1, len(FEATURES))
        both = real[:, 1:] & real[:, :-1]
        seen_pairs = np.zeros((2, 2))
        np.add.at(seen_pairs, (y[:, :-1][both], y[:, 1:][both]), 1)
        seen = {
            "weight": (y * real).reshape(-1) @ flat, "start": np.bincount(y[:, 0], minlength=2).astype(float), "step": seen_pairs,
        }
        p = {"weight": np.zeros(len(FEATURES)), "start": np.zeros(2), "step": np.zeros((2, 2))}
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            one, pairs = ChainField._marginals((flat @ p["weight"]).reshape(count, longest), real, p["start"], p["step"])
            expected = {"weight": (one * real).reshape(-1) @ flat, "start": np.array([(1 - one[:, 0]).sum(), one[:, 0].sum()]), "step": pairs}
            for k in p:
                grad = (expected[k] - seen[k]) / count + L2 * p[k] / 10
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad**2
                p[k] -= RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
        return ChainField(p["weight"], p["start"], p["step"])

    @staticmethod
    def _marginals(gain, real, start, step) -> tuple[np.ndarray, np.ndarray]:
        """(probability of label 1 of each block, expected number of each pair of labels)."""
        count, longest = gain.shape
        score = np.stack([np.zeros_like(gain), gain], 2)
        forward = np.zeros((count, longest, 2))
        backward = np.zeros((count, longest, 2))
        forward[:, 0] = start + score[:, 0]
        for j in range(1, longest):
            moved = np.logaddexp.reduce(forward[:, j - 1, :, None] + step, 1) + score[:, j]
            forward[:, j] = np.where(real[:, j, None], moved, forward[:, j - 1])
        for j in range(longest - 2, -1, -1):
            moved = np.logaddexp.reduce(step + (score[:, j + 1] + backward[:, j + 1])[:, None, :], 2)
            backward[:, j] = np.where(real[:, j + 1, None], moved, 0.0)
        total = np.logaddexp.reduce(forward[:, 0] + backward[:, 0], 1)
        one = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
        pairs = np.exp(
            forward[:, :-1, :, None] + step + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        return one, (pairs * real[:, 1:, None, None]).sum((0, 1))


def fit(training_pages: int = TRAINING_PAGES, pages: list[tuple[str, list[int]]] | None = None) -> ChainField:
    """Train on labelled pages: given ones, or ``training_pages`` made ones."""
    pages = pages or labelled_pages(training_pages)
    return ChainField.fit([[b.features for b in blocks(html)] for html, _ in pages], [labels for _, labels in pages])


def main_text(html: str | None, field: ChainField) -> str:
    page = blocks(html)
    kept = field.decode([b.features for b in page])
    return "\n\n".join(b.text for b, label in zip(page, kept) if label)


def extracted(pages: DataFrame, html: str = "html", field: ChainField | None = None) -> DataFrame:
    """The rows without their html, with ``text`` and ``n_chars``; columns of these names are replaced.

    Null and empty pages and pages without article blocks give an empty text.
    """
    field = field or fit()
    own = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    text = per_slice(html, "string", lambda: lambda texts: [main_text(t, field) for t in texts])
    return pages.select(*own, text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
