"""Kernels over small bitmaps, and their packed forms.

Bitmaps travel as struct<h, w, b>, b being base64 of the row-major bits, most
significant first, zero padded. Bitmaps of at most 64 bits fit one BIGINT and
are compared inside the JVM with XOR and bit counts; others go through
Arrow-batched pandas UDFs built from the numpy kernels here.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Acceptance of a name by normalised distance, its margin over
#: the runner-up, grey level of ink.
MOST_DISTANCE, LEAST_MARGIN, INK_LEVEL = 0.70, 0.12, 150
CANVAS = (24, 24)


def pack(mask: np.ndarray) -> tuple[int, int, str]:
    h, w = mask.shape
    return h, w, base64.b64encode(np.packbits(mask.astype(bool).ravel()).tobytes()).decode("ascii")


def unpack(h: int, w: int, b: str) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(base64.b64decode(b), np.uint8))
    return bits[: h * w].reshape(h, w).astype(bool)


def from_rows(rows: Sequence[str]) -> np.ndarray:
    """A bitmap drawn with '#' and '.'."""
    return np.array([[c == "#" for c in row] for row in rows], bool).reshape(len(rows), -1)


def to_rows(mask: np.ndarray) -> list[str]:
    return ["".join(".#"[int(x)] for x in row) for row in mask]


def binarise(grey: np.ndarray, level: int = INK_LEVEL) -> np.ndarray:
    return grey > level


def true_spans(flags: np.ndarray) -> np.ndarray:
    """Half-open [start, end) of the runs of True, as an [n, 2] array."""
    edges = np.diff(np.concatenate([[0], np.asarray(flags, np.int8), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)


def merged_spans(spans: np.ndarray, gap: int) -> np.ndarray:
    """Spans joined where fewer than ``gap`` cells part them."""
    if not len(spans):
        return spans
    new = np.concatenate([[True], spans[1:, 0] - spans[:-1, 1] >= gap])
    last = np.concatenate([new[1:], [True]])
    return np.stack([spans[new, 0], spans[last, 1]], 1)


def glyph_spans(mask: np.ndarray, min_gap: int = 1, min_ink: int = 1) -> np.ndarray:
    """Column spans of separate glyphs."""
    return merged_spans(true_spans(mask.sum(0) >= min_ink), min_gap)


def grouped(indices: Sequence[int], max_gap: int) -> list[tuple[int, int]]:
    """Inclusive runs of sorted numbers, split where they jump."""
    x = np.asarray(indices, int)
    if not len(x):
        return []
    cut = np.flatnonzero(np.diff(x) > max_gap)
    return list(zip(x[np.concatenate([[0], cut + 1])].tolist(), x[np.concatenate([cut, [len(x) - 1]])].tolist(), strict=True))


def tight(mask: np.ndarray) -> np.ndarray:
    """The bounding box of the ink; 0 x 0 without ink."""
    rows, cols = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    return mask[rows[0] : rows[-1] + 1, cols[0] : cols[-1] + 1] if len(rows) else np.zeros((0, 0), bool)


def on_canvas(mask: np.ndarray, canvas: tuple[int, int] = CANVAS) -> np.ndarray:
    """The bitmap in the top left of a blank canvas."""
    if mask.shape[0] > canvas[0] or mask.shape[1] > canvas[1]:
        raise ValueError(f"a bitmap of {mask.shape} does not fit {canvas}")
    out = np.zeros(canvas, bool)
    out[: mask.shape[0], : mask.shape[1]] = mask
    return out


def shifts(mask: np.ndarray, reach: int) -> Iterable[np.ndarray]:
    """Circular shifts by up to ``reach`` in both directions."""
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            yield np.roll(mask, (dy, dx), (0, 1))


def hamming(a: np.ndarray, b: np.ndarray, reach: int = 0) -> int:
    """Least number of unequal cells over small shifts (equal shapes)."""
    return min(int(np.count_nonzero(s ^ b)) for s in shifts(a, reach))


def normalised_distance(a: np.ndarray, b: np.ndarray, reach: int = 1) -> float:
    """Unequal cells over cells with ink in either, least over small shifts; 1
    if there is no ink."""
    shape = tuple(np.maximum(a.shape, b.shape))
    a, b = on_canvas(a, shape), on_canvas(b, shape)
    best = 1.0
    for s in shifts(a, reach):
        union = np.count_nonzero(s | b)
        if union:
            best = min(best, np.count_nonzero(s ^ b) / union)
    return float(best)


def majority(masks: Sequence[np.ndarray]) -> np.ndarray:
    """Cells set in more than half of the bitmaps, padded to the largest."""
    if not masks:
        raise ValueError("no bitmaps")
    shape = np.max([m.shape for m in masks], axis=0)
    return sum(on_canvas(m, tuple(shape)).astype(int) for m in masks) * 2 > len(masks)


def modal_majority(masks: Sequence[np.ndarray], ties_on: bool = False) -> np.ndarray | None:
    """The majority of the bitmaps of the most frequent shape (first of equals)."""
    if not masks:
        return None
    shapes = [m.shape for m in masks]
    shape = max(dict.fromkeys(shapes), key=shapes.count)
    same = [m for m in masks if m.shape == shape]
    votes = sum(m.astype(int) for m in same) * 2
    return votes >= len(same) if ties_on else votes > len(same)


def best_two(scores: dict[str, float]) -> tuple[str, float, str | None, float | None]:
    """(label, distance, runner-up, its distance); equal distances by label."""
    if not scores:
        raise ValueError("no templates")
    order = sorted((d, label) for label, d in scores.items())
    second = order[1] if len(order) > 1 else (None, None)
    return order[0][1], order[0][0], second[1], second[0]


def nearest_glyph(mask: np.ndarray, atlas: dict[str, np.ndarray], reach: int = 1, canvas: tuple[int, int] = CANVAS):
    """The glyph of an atlas nearest to a bitmap on the canvas."""
    probe = on_canvas(mask, canvas)
    return best_two({label: hamming(probe, t, reach) for label, t in atlas.items()})


def nearest_template(mask: np.ndarray, templates: dict[str, np.ndarray], tolerance: int = 3, reach: int = 1):
    """The template nearest to a whole region, of those about its shape; a
    LookupError if there is none."""
    mask = tight(mask)
    fit = {k: t for k, t in templates.items() if max(abs(t.shape[0] - mask.shape[0]), abs(t.shape[1] - mask.shape[1])) <= tolerance}
    if not fit:
        raise LookupError(f"no template about {mask.shape}")
    scores = {}
    for label, t in fit.items():
        shape = tuple(np.maximum(t.shape, mask.shape))
        scores[label] = hamming(on_canvas(mask, shape), on_canvas(t, shape), reach)
    return best_two(scores)


def rank_names(mask: np.ndarray, names: dict[str, Sequence[np.ndarray]]) -> list[tuple[float, str]]:
    """All names by the normalised distance of their nearest variant."""
    if not names:
        raise ValueError("no templates")
    probe = tight(mask)
    return sorted((min(normalised_distance(probe, v) for v in variants), label) for label, variants in names.items())


def accept(ranked: list[tuple[float, str]], most: float = MOST_DISTANCE, margin: float = LEAST_MARGIN) -> tuple[str | None, float, str | None, float]:
    """(label or None, distance, runner-up, its distance)."""
    best = ranked[0]
    second = ranked[1] if len(ranked) > 1 else (1.0, None)
    sure = best[0] <= most and second[0] - best[0] >= margin
    return best[1] if sure else None, best[0], second[1], second[0]


def accept_pair(first: list[tuple[float, str]], second: list[tuple[float, str]], sides: dict[str, str], most: float = MOST_DISTANCE, margin: float = LEAST_MARGIN):
    """Two names read together, of different sides, at least total distance;
    each is then held to the limits against its own best rival."""
    pairs = [(a + b, i, j) for i, (a, x) in enumerate(first) for j, (b, y) in enumerate(second) if sides.get(x) != sides.get(y)]
    if not pairs:
        return (None, 1.0, None, 1.0), (None, 1.0, None, 1.0)
    _, i, j = min(pairs)
    chosen = []
    for ranked, k in ((first, i), (second, j)):
        rest = ranked[:k] + ranked[k + 1 :]
        chosen.append(accept([ranked[k], *rest[:1]], most, margin))
    return chosen[0], chosen[1]


def read_text(grey: np.ndarray, atlas: dict[str, np.ndarray], level: int = INK_LEVEL, min_gap: int = 1, canvas: tuple[int, int] = CANVAS):
    """(text, matches) of a cell: ink, glyphs, nearest glyph each."""
    ink = binarise(grey, level)
    found = [nearest_glyph(tight(ink[:, a:b]), atlas, canvas=canvas) for a, b in glyph_spans(ink, min_gap)]
    return "".join(m[0] for m in found), found


# Columns


def sign_bits(values: Column, n: int = 64) -> Column:
    """An array of numbers as one BIGINT: bit i is set where value i is above
    zero."""
    bit = lambda acc, i: acc.bitwiseOR(F.when(F.element_at(values, (i + 1).cast("int")) > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0).cast("bigint"), bit)


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def normalised_bit_distance(a: Column, b: Column) -> Column:
    """As ``normalised_distance`` without shifts, on packed bitmaps."""
    union = F.bit_count(a.bitwiseOR(b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.bit_count(a.bitwiseXOR(b)) / union)


def name_udf(names: dict[str, list[np.ndarray]], most: float = MOST_DISTANCE, margin: float = LEAST_MARGIN):
    """A pandas UDF from struct<h, w, b> to struct<label, distance, runner_up,
    runner_up_distance>."""

    @F.pandas_udf("label string, distance double, runner_up string, runner_up_distance double")
    def match(bitmap: pd.DataFrame) -> pd.DataFrame:
        known: dict[tuple, tuple] = {}
        out = []
        for key in zip(bitmap["h"], bitmap["w"], bitmap["b"], strict=True):
            if key not in known:
                known[key] = (None,) * 4 if key[2] is None else accept(rank_names(unpack(*key), names), most, margin)
            out.append(known[key])
        return pd.DataFrame(out, columns=["label", "distance", "runner_up", "runner_up_distance"])

    return match


def text_udf(atlas: dict[str, np.ndarray], level: int = INK_LEVEL):
    """A pandas UDF from struct<h, w, grey> (grey: bytes) to the text read."""

    @F.pandas_udf("string")
    def read(cell: pd.DataFrame) -> pd.Series:
        rows = zip(cell["h"], cell["w"], cell["grey"], strict=True)
        return pd.Series([None if g is None else read_text(np.frombuffer(g, np.uint8).reshape(h, w), atlas, level)[0] for h, w, g in rows])

    return read
