"""Brute-force NumPy references for the ranking and calibration metrics.

Written from the metric definitions (threshold = every distinct score,
predict positive for ``score >= t``), looping over thresholds; slow on
purpose, used only on small inputs.
"""

from __future__ import annotations

import numpy as np


def _thresholds(s):
    return np.unique(s)[::-1]          # descending distinct scores


def roc_auc(y, s):
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    tot = 0.0
    for p in pos:
        tot += np.sum(p > neg) + 0.5 * np.sum(p == neg)
    return tot / (len(pos) * len(neg))


def curve(y, s):
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    out = []
    for t in _thresholds(s):
        pred = s >= t
        tp = int(np.sum(pred & (y == 1)))
        fp = int(np.sum(pred & (y == 0)))
        out.append((t, tp, fp))
    return out


def average_precision(y, s):
    P = int(np.sum(np.asarray(y) == 1))
    if P == 0:
        return None
    ap, prev_r = 0.0, 0.0
    for _, tp, fp in curve(y, s):
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def pr_auc_trapezoid(y, s):
    P = int(np.sum(np.asarray(y) == 1))
    if P == 0:
        return None
    pts = [(0.0, 1.0)] + [(tp / P, tp / (tp + fp)) for _, tp, fp in curve(y, s)]
    area = 0.0
    for (r0, p0), (r1, p1) in zip(pts, pts[1:]):
        area += (r1 - r0) * (p0 + p1) / 2
    return area


def best_f1(y, s):
    P = int(np.sum(np.asarray(y) == 1))
    c = curve(y, s)[::-1]               # ascending thresholds
    if len(c) <= 1:
        return 0.0, 0.5
    best, thr = -1.0, None
    for t, tp, fp in c[:-1]:            # highest threshold excluded
        d = 2 * tp + fp + (P - tp)
        f1 = 0.0 if d == 0 else 2 * tp / d
        if f1 > best:
            best, thr = f1, t
    return best, thr


def calibration(y, p, n_bins=10):
    y, p = np.asarray(y, dtype=float), np.asarray(p, dtype=float)
    edges = np.percentile(p, np.linspace(0, 1, n_bins + 1) * 100)
    ids = np.searchsorted(edges[1:-1], p)      # side="left": edges strictly below
    rows = []
    for b in range(n_bins):
        m = ids == b
        if m.any():
            rows.append((b, float(p[m].mean()), float(y[m].mean())))
    return rows
