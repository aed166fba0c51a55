"""Pixel kernels in numpy, for use inside batched functions over frames kept as binary columns."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Fixed: Bayer orders by colour id of the SER format, as the sites (row, column) of red and blue in a 2 x 2 cell.
BAYER = {8: ((0, 0), (1, 1)), 9: ((0, 1), (1, 0)), 10: ((1, 0), (0, 1)), 11: ((1, 1), (0, 0))}


def _sites(color_id: int):
    if color_id not in BAYER:
        raise ValueError(f"colour id {color_id} is no Bayer layout")
    red, blue = BAYER[color_id]
    greens = [(r, c) for r in (0, 1) for c in (0, 1) if (r, c) not in (red, blue)]
    return red, greens, blue


def _site(raw: np.ndarray, at: tuple[int, int], full: float) -> np.ndarray:
    return raw[at[0] :: 2, at[1] :: 2].astype(np.float32) / np.float32(full)


def superpixel(raw: np.ndarray, color_id: int, full: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-size red, green, blue in [0, 1]; green is the mean of both sites."""
    if raw.shape[0] % 2 or raw.shape[1] % 2:
        raise ValueError("odd frame size")
    red, greens, blue = _sites(color_id)
    return _site(raw, red, full), (_site(raw, greens[0], full) + _site(raw, greens[1], full)) / 2, _site(raw, blue, full)


def green(raw: np.ndarray, color_id: int, full: float) -> np.ndarray:
    if raw.shape[0] % 2 or raw.shape[1] % 2:
        raise ValueError("odd frame size")
    _, greens, _ = _sites(color_id)
    return (_site(raw, greens[0], full) + _site(raw, greens[1], full)) / 2


def superpixel_mono(raw: np.ndarray, full: float) -> np.ndarray:
    return decimate(raw.astype(np.float32) / np.float32(full), 2)


_NEAR, _DIAGONAL = ((0, -1), (0, 1), (-1, 0), (1, 0)), ((-1, -1), (-1, 1), (1, -1), (1, 1))


def bilinear(raw: np.ndarray, color_id: int, full: float) -> np.ndarray:
    """Full-size colour: own sites as they are, others the mean of the neighbours that the layout has for the colour; beyond an edge stands its value."""
    red, greens, blue = _sites(color_id)
    padded = np.pad(raw.astype(np.float32) / np.float32(full), 1, mode="edge")
    height, width = raw.shape
    out = np.empty((height, width, 3), np.float32)
    for k, sites in enumerate(([red], greens, [blue])):
        for py in (0, 1):
            for px in (0, 1):
                beside = [(dy, dx) for dy, dx in _NEAR if ((py + dy) % 2, (px + dx) % 2) in sites]
                offsets = [(0, 0)] if (py, px) in sites else beside or list(_DIAGONAL)
                out[py::2, px::2, k] = sum(padded[1 + py + dy : 1 + height + dy : 2, 1 + px + dx : 1 + width + dx : 2] for dy, dx in offsets) / np.float32(len(offsets))
    return out


def emission_plane(r: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Red minus green scaled by the ratio of their medians."""
    return r - np.median(r) / max(float(np.median(g)), 1e-3) * g


def decimate(x: np.ndarray, k: int) -> np.ndarray:
    h, w = x.shape[0] // k * k, x.shape[1] // k * k
    return x[:h, :w].reshape(h // k, k, w // k, k).mean(axis=(1, 3))


def masked_decimate(x: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    share = decimate(mask.astype(np.float64), k)
    return np.where(share > 0, decimate(x * mask, k) / np.maximum(share, 1e-12), 0), share >= 0.5


def pyramid(x: np.ndarray) -> list[np.ndarray]:
    return [decimate(x, 16), decimate(x, 4), x]


def box_blur(x: np.ndarray, r: int) -> np.ndarray:
    """Mean over a square of 2 r + 1, clipped at the edges, by running sums."""
    for axis in (0, 1):
        n = x.shape[axis]
        c = np.concatenate((np.zeros_like(np.take(x, [0], axis), np.float64), np.cumsum(x, axis=axis, dtype=np.float64)), axis=axis)
        hi, lo = np.minimum(np.arange(n) + r + 1, n), np.maximum(np.arange(n) - r, 0)
        width = (hi - lo).reshape([-1 if a == axis else 1 for a in (0, 1)])
        x = (np.take(c, hi, axis) - np.take(c, lo, axis)) / width
    return x


def translate(x: np.ndarray, dx: float, dy: float) -> np.ndarray:
    """Content moved by (dx, dy) with bilinear weights; zero where nothing comes from."""
    out = np.zeros(x.shape, np.float64)
    iy, ix = int(np.floor(dy)), int(np.floor(dx))
    fy, fx = dy - iy, dx - ix
    for sy, wy in ((iy, 1 - fy), (iy + 1, fy)):
        for sx, wx in ((ix, 1 - fx), (ix + 1, fx)):
            if wy * wx == 0:
                continue
            y0, y1 = max(0, sy), min(x.shape[0], x.shape[0] + sy)
            x0, x1 = max(0, sx), min(x.shape[1], x.shape[1] + sx)
            if y0 < y1 and x0 < x1:
                out[y0:y1, x0:x1] += wy * wx * x[y0 - sy : y1 - sy, x0 - sx : x1 - sx]
    return out


def crop(x: np.ndarray, ox: float, oy: float, w: int, h: int) -> np.ndarray:
    """Window at a sub-pixel origin, black outside."""
    iy, ix = int(np.floor(oy)), int(np.floor(ox))
    out = np.zeros((h + 1, w + 1))
    y0, y1, x0, x1 = max(0, iy), min(x.shape[0], iy + h + 1), max(0, ix), min(x.shape[1], ix + w + 1)
    if y0 < y1 and x0 < x1:
        out[y0 - iy : y1 - iy, x0 - ix : x1 - ix] = x[y0:y1, x0:x1]
    fy, fx = oy - iy, ox - ix
    return (1 - fy) * ((1 - fx) * out[:-1, :-1] + fx * out[:-1, 1:]) + fy * ((1 - fx) * out[1:, :-1] + fx * out[1:, 1:])


def ncc(a: np.ndarray, b: np.ndarray, dx: int, dy: int, least: int = 64) -> float:
    """Correlation of a with b moved by whole pixels; -2 where they overlap too little or are flat."""
    y0, y1, x0, x1 = max(0, dy), min(a.shape[0], b.shape[0] + dy), max(0, dx), min(a.shape[1], b.shape[1] + dx)
    if y1 - y0 < 1 or x1 - x0 < 1 or (y1 - y0) * (x1 - x0) < least:
        return -2.0
    p, q = a[y0:y1, x0:x1].astype(np.float64), b[y0 - dy : y1 - dy, x0 - dx : x1 - dx].astype(np.float64)
    p, q = p - p.mean(), q - q.mean()
    d = np.sqrt((p * p).sum() * (q * q).sum())
    return float((p * q).sum() / d) if d > 1e-12 else -2.0


def _vertex(lo: float, mid: float, hi: float) -> float:
    d = lo - 2 * mid + hi
    return 0.0 if d == 0 else float(np.clip((lo - hi) / (2 * d), -0.5, 0.5))


def match_shift(a: np.ndarray, b: np.ndarray, reach: int = 4) -> tuple[float, float, float]:
    """Coarse-to-fine shift (dx, dy) of b onto a, sub-pixel by a parabola, and its correlation."""
    cx = cy = 0
    for k, (p, q) in enumerate(zip(pyramid(a), pyramid(b), strict=True)):
        if k:
            cx, cy = cx * 4, cy * 4
        if min(p.shape) < 8:
            continue
        best = max((ncc(p, q, cx + i, cy + j), cx + i, cy + j) for j in range(-reach, reach + 1) for i in range(-reach, reach + 1))
        score, cx, cy = best
    return cx + _vertex(ncc(a, b, cx - 1, cy), score, ncc(a, b, cx + 1, cy)), cy + _vertex(ncc(a, b, cx, cy - 1), score, ncc(a, b, cx, cy + 1)), score


def phase_shift(ref: np.ndarray, img: np.ndarray) -> tuple[float, float]:
    """Displacement (dx, dy) of an image against a reference, by windowed phase correlation."""
    window = np.outer(np.hanning(ref.shape[0]), np.hanning(ref.shape[1]))
    f = np.fft.rfft2((img - img.mean()) * window) * np.conj(np.fft.rfft2((ref - ref.mean()) * window))
    c = np.fft.irfft2(f / np.maximum(np.abs(f), 1e-12), s=ref.shape)
    y, x = np.unravel_index(int(c.argmax()), c.shape)
    h, w = c.shape
    dx = x + _vertex(c[y, x - 1], c[y, x], c[y, (x + 1) % w])
    dy = y + _vertex(c[y - 1, x], c[y, x], c[(y + 1) % h, x])
    return float(dx - w if dx > w / 2 else dx), float(dy - h if dy > h / 2 else dy)


def drizzle(planes, shifts, factor: int) -> np.ndarray:
    """Mean of planes enlarged by a factor and moved back by their shifts."""
    total = 0
    for x, (dx, dy) in zip(planes, shifts, strict=True):
        total = total + translate(np.repeat(np.repeat(x, factor, 0), factor, 1), -dx * factor, -dy * factor)
    return total / len(planes)


def blobs(mask: np.ndarray) -> list[dict[str, int]]:
    """8-connected components: area and bounding box, by runs and union-find."""
    parent: list[int] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs, above = [], []
    for y in range(mask.shape[0]):
        edge = np.diff(np.concatenate(([0], mask[y].astype(np.int8), [0])))
        here = []
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            i = len(parent)
            parent.append(i)
            for pa, pb, j in above:
                if pa <= b and pb >= a:
                    parent[find(i)] = find(j)
            here.append((a, b, i))
            runs.append((y, a, b, i))
        above = here
    out: dict[int, dict[str, int]] = {}
    for y, a, b, i in runs:
        d = out.setdefault(find(i), {"area": 0, "x0": a, "y0": y, "x1": b, "y1": y + 1})
        d["area"] += b - a
        d["x0"], d["x1"], d["y1"] = min(d["x0"], a), max(d["x1"], b), max(d["y1"], y + 1)
    return sorted(out.values(), key=lambda d: (-d["area"], d["y0"], d["x0"]))


def centroid(x: np.ndarray, share: float = 0.02) -> tuple[float, float]:
    """Weighted centre of the brightest share of pixels."""
    cut = np.partition(x.ravel(), int(x.size * (1 - share)))[int(x.size * (1 - share))]
    y, c = np.nonzero(x >= cut)
    w = x[y, c].astype(np.float64)
    return float((c * w).sum() / w.sum()), float((y * w).sum() / w.sum())


def limb_points(x: np.ndarray, level: float, step: int = 1) -> np.ndarray:
    """First and last bright pixel of each scanned row."""
    out = []
    for y in range(0, x.shape[0], step):
        c = np.flatnonzero(x[y] > level)
        if len(c):
            out += [(c[0], y), (c[-1], y)]
    return np.array(out, np.float64).reshape(-1, 2)


def ring_profile(x: np.ndarray, cx: float, cy: float, radii: np.ndarray, rays: int = 360) -> np.ndarray:
    """Bilinear samples on rays (rows) at radii (columns); NaN outside."""
    turn = np.arange(rays) * 2 * np.pi / rays
    px, py = cx + np.outer(np.cos(turn), radii), cy + np.outer(np.sin(turn), radii)
    ix, iy = np.floor(px).astype(int), np.floor(py).astype(int)
    ok = (ix >= 0) & (iy >= 0) & (ix < x.shape[1] - 1) & (iy < x.shape[0] - 1)
    ix, iy = np.where(ok, ix, 0), np.where(ok, iy, 0)
    fx, fy = px - ix, py - iy
    v = (1 - fy) * ((1 - fx) * x[iy, ix] + fx * x[iy, ix + 1]) + fy * ((1 - fx) * x[iy + 1, ix] + fx * x[iy + 1, ix + 1])
    return np.where(ok, v, np.nan)


def ring_search(x: np.ndarray, radius: float, seed: tuple[float, float], reach: int = 12) -> tuple[float, float, float]:
    """Centre whose ring of a radius has the strongest outward step; grids that close in on it."""
    radii = np.array([radius - 2, radius + 2])

    def score(c):
        p = ring_profile(x, *c, radii, 180)
        d = p[:, 1] - p[:, 0]
        return float(np.abs(np.nanmean(d))) if np.isfinite(d).mean() >= 0.6 else -1.0

    (cx, cy), step = seed, max(1.0, reach / 3)
    while step > 0.05:
        grid = [(cx + i * step, cy + j * step) for j in (-2, -1, 0, 1, 2) for i in (-2, -1, 0, 1, 2)]
        cx, cy = max(grid, key=score)
        step /= 2
    return cx, cy, score((cx, cy))


def annulus_median(x: np.ndarray, cx: float, cy: float, inner: float, outer: float, least: int = 100) -> float:
    y, c = np.indices(x.shape)
    r2 = (c - cx) ** 2 + (y - cy) ** 2
    v = np.sort(x[(r2 >= inner * inner) & (r2 < outer * outer)][::2])
    return float(v[len(v) // 2]) if len(v) >= least else 0.0


def radial_profile(x: np.ndarray, cx: float, cy: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and count by integer radius."""
    y, c = np.indices(x.shape)
    r = np.floor(np.hypot(c - cx, y - cy) + 0.5).astype(int)
    n = np.bincount(r.ravel())
    return np.bincount(r.ravel(), weights=x.ravel()) / np.maximum(n, 1), n


def radial_power(x: np.ndarray) -> np.ndarray:
    """Radial mean of the windowed power spectrum, normalised."""
    p = np.abs(np.fft.fftshift(np.fft.fft2((x - x.mean()) * np.outer(np.hanning(x.shape[0]), np.hanning(x.shape[1]))))) ** 2
    mean, _ = radial_profile(p, x.shape[1] // 2, x.shape[0] // 2)
    mean = mean[: min(x.shape) // 2]
    return mean / max(mean.sum(), 1e-30)


def suppressed_peaks(x: np.ndarray, mask: np.ndarray, k: int, radius: float, snr: float) -> list[tuple[int, int, float]]:
    """Greedy highest robust scores, each keeping others away by a radius, down to a signal-to-noise ratio."""
    v = np.sort(x[mask])
    if not len(v):
        return []
    med = v[len(v) // 2]
    sigma = max(float(np.sort(np.abs(v - med))[len(v) // 2]) * 1.4826, 1e-12)
    z = np.where(mask, (x - med) / sigma, -np.inf)
    yy, xx = np.indices(x.shape)
    out = []
    while len(out) < k:
        y, c = np.unravel_index(int(z.argmax()), z.shape)
        if z[y, c] < snr:
            break
        out.append((int(c), int(y), float(z[y, c])))
        z[(xx - c) ** 2 + (yy - y) ** 2 <= radius * radius] = -np.inf
    return out


def sharpness(x: np.ndarray) -> tuple[float, float, float]:
    """Edge RMS in the brightest hundredth, sky noise, and their ratio."""
    gy, gx = np.gradient(x.astype(np.float64))
    g = gx * gx + gy * gy
    bright = x >= np.quantile(x, 0.99)
    sky = x[x <= np.quantile(x, 0.5)]
    noise = float(np.median(np.abs(sky - np.median(sky))))
    edge = float(np.sqrt(g[bright].mean()))
    return edge, noise, edge / max(noise, 1e-12)


def weighted_merge(images, weights) -> np.ndarray:
    """Mean of images by per-pixel weights; 0 where none has weight."""
    w = np.stack(weights).astype(np.float64)
    return (np.stack(images) * w).sum(0) / np.maximum(w.sum(0), 1e-12) * (w.sum(0) > 0)


def to_display(x: np.ndarray, gamma: float, black: float, white: float) -> np.ndarray:
    return (np.clip((x - black) / (white - black), 0, 1) ** gamma * 255 + 0.5).astype(np.uint8)


def encode_png(x: np.ndarray) -> bytes:
    """8- or 16-bit grey or colour PNG."""
    depth, colour = 8 * x.dtype.itemsize, 2 if x.ndim == 3 else 0
    rows = x.astype(x.dtype.newbyteorder(">")).reshape(x.shape[0], -1).view(np.uint8)
    raw = np.concatenate((np.zeros((x.shape[0], 1), np.uint8), rows), axis=1).tobytes()
    part = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", x.shape[1], x.shape[0], depth, colour, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def complete_png(raw: bytes) -> bool:
    """Whether a PNG was written to its end."""
    return raw[-8:-4] == b"IEND"
