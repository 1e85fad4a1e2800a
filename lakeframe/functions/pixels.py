"""Pixel helpers run inside Arrow-batched pandas tasks.

Only per-image numpy work lives here; Spark partitions the images and decodes them with
its own ``image`` source.
"""

from __future__ import annotations

import numpy as np

def resize_bilinear(img: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres and edge clamping (the usual INTER_LINEAR
    convention); returns uint8 with rounding.  Identity when the size does not change."""
    h, w = img.shape[:2]
    if (h, w) == (out_h, out_w):
        return img.copy()
    src = img.astype(np.float64)
    if src.ndim == 2:
        src = src[:, :, None]

    def axis(n_in, n_out):
        pos = (np.arange(n_out) + 0.5) * (n_in / n_out) - 0.5
        pos = np.clip(pos, 0, n_in - 1)
        lo = np.floor(pos).astype(np.int64)
        hi = np.minimum(lo + 1, n_in - 1)
        return lo, hi, (pos - lo)

    y0, y1, wy = axis(h, out_h)
    x0, x1, wx = axis(w, out_w)
    wx = wx[None, :, None]
    top = src[y0][:, x0] * (1 - wx) + src[y0][:, x1] * wx
    bottom = src[y1][:, x0] * (1 - wx) + src[y1][:, x1] * wx
    out = top * (1 - wy[:, None, None]) + bottom * wy[:, None, None]
    out = np.clip(np.rint(out), 0, 255).astype(np.uint8)
    return out[:, :, 0] if img.ndim == 2 else out


def bgr_to_rgb(img: np.ndarray) -> np.ndarray:
    """Reverse the channel axis of a 3-channel image (X15); other images pass through."""
    if img.ndim == 3 and img.shape[2] == 3:
        return img[:, :, ::-1]
    return img
