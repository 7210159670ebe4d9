"""SVG figures of collected points: a few thousand at most (``karyotype.pixel_density`` thins out more)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from html import escape

Points = Sequence[tuple[float, float]]


def ticks(lo: float, hi: float, about: int = 5) -> list[float]:
    """Round numbers within [lo, hi], in steps of 1, 2 or 5 times a power of ten; one where the range is empty."""
    if not hi > lo:
        return [lo]
    rough = (hi - lo) / about
    scale = 10.0 ** math.floor(math.log10(rough))
    step = next(m * scale for m in (1, 2, 5, 10) if m * scale >= rough * (1 - 1e-9))
    return [k * step for k in range(math.ceil(lo / step - 1e-9), math.floor(hi / step + 1e-9) + 1)]


@dataclass
class Axes:
    """One panel: layers of dots and lines over common limits, which are the data's where none are set."""

    title: str = ""
    x_label: str = ""
    y_label: str = ""
    x_limits: tuple[float, float] | None = None
    y_limits: tuple[float, float] | None = None
    x_names: Sequence[tuple[float, str]] | None = None
    layers: list[tuple[str, Points, str, str]] = field(default_factory=list)

    def scatter(self, points: Points, label: str = "", color: str = "steelblue") -> Axes:
        self.layers.append(("scatter", points, label, color))
        return self

    def line(self, points: Points, label: str = "", color: str = "firebrick") -> Axes:
        self.layers.append(("line", points, label, color))
        return self

    def _limits(self, which: int) -> tuple[float, float]:
        asked = (self.x_limits, self.y_limits)[which]
        found = [p[which] for _, points, *_ in self.layers for p in points]
        lo, hi = asked or ((min(found), max(found)) if found else (0.0, 1.0))
        return (lo, hi) if hi > lo else (lo - 0.5, lo + 0.5)

    def draw(self, left: float, top: float, width: float, height: float) -> str:
        (x0, x1), (y0, y1) = self._limits(0), self._limits(1)
        px = lambda x: left + (x - x0) / (x1 - x0) * width
        py = lambda y: top + height - (y - y0) / (y1 - y0) * height
        text = lambda x, y, s, more="": f'<text x="{x:.1f}" y="{y:.1f}" font-size="11" text-anchor="middle"{more}>{escape(str(s))}</text>'
        out = [f'<rect x="{left}" y="{top}" width="{width}" height="{height}" fill="none" stroke="black"/>', text(left + width / 2, top - 8, self.title)]
        out += [text(left + width / 2, top + height + 32, self.x_label), text(left - 42, top + height / 2, self.y_label, f' transform="rotate(-90 {left - 42:.1f} {top + height / 2:.1f})"')]
        out += [text(px(x), top + height + 15, name) for x, name in self.x_names or [(x, f"{x:g}") for x in ticks(x0, x1)] if x0 <= x <= x1]
        out += [text(left - 18, py(y) + 4, f"{y:g}") for y in ticks(y0, y1)]
        for kind, points, _, color in self.layers:
            inside = [(px(x), py(y)) for x, y in points if x0 <= x <= x1 and y0 <= y <= y1]
            if kind == "line" and inside:
                out.append(f'<polyline fill="none" stroke="{color}" points="{" ".join(f"{x:.1f},{y:.1f}" for x, y in inside)}"/>')
            elif inside:  # one path for all dots of a layer
                out.append(f'<path fill="none" stroke="{color}" stroke-width="3" stroke-linecap="round" d="{"".join(f"M{x:.1f} {y:.1f}h0" for x, y in dict.fromkeys((round(x, 1), round(y, 1)) for x, y in inside))}"/>')
        named = [(label, color) for _, _, label, color in self.layers if label]
        for i, (label, color) in enumerate(named):
            out.append(f'<rect x="{left + width - 110}" y="{top + 8 + 16 * i}" width="10" height="10" fill="{color}"/>' + text(left + width - 55, top + 17 + 16 * i, label))
        return "".join(out)


def figure(rows: Sequence[Axes], width: int = 1000, height: int = 320) -> str:
    """Panels one below the other."""
    body = "".join(a.draw(70, 30 + i * height, width - 100, height - 80) for i, a in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height * len(rows)}" font-family="sans-serif">{body}</svg>'


def karyotype_figure(bins: Sequence[tuple[str, float]], medians: Sequence[tuple[str, float]], bafs: Sequence[tuple[str, float, float]] = ()) -> str:
    """Depth of (segment, coverage) bins in the order given, with the segments' medians as lines; below, allele frequencies (segment, place in it from 0 to 1, frequency)."""
    spans: dict[str, list[int]] = {}
    for i, (segment, _) in enumerate(bins):
        spans.setdefault(segment, [i, i])[1] = i
    names = [((lo + hi) / 2, s) for s, (lo, hi) in spans.items()]
    limits = (0.0, max(1.0, len(bins) - 1.0))
    depth = Axes("Depth by segment", y_label="depth", x_names=names, x_limits=limits).scatter([(i, y) for i, (_, y) in enumerate(bins)], "bins")
    for segment, median in medians:
        if segment in spans:
            depth.line([(spans[segment][0], median), (spans[segment][1], median)])
    baf = Axes("Allele frequency", x_label="segment", y_label="frequency", x_names=names, x_limits=limits, y_limits=(0.0, 1.0))
    baf.scatter([(spans[s][0] + at * (spans[s][1] - spans[s][0]), y) for s, at, y in bafs if s in spans], color="seagreen")
    return figure([depth, baf] if bafs else [depth])
