"""Plain-loop versions of the time-series operators, for small frames only."""

import math

import numpy as np
import pandas as pd

HOUR = 3600 * 10**6


def random_log(seed, rows=250, machines=3, ties=True, gaps=0.15, hot=None):
    """Readings of a few machines; ``hot`` is the share machine M0 holds."""
    rng = np.random.default_rng(seed)
    step = 600 if ties else 1
    span = 3 * 24 * 3600
    if ties:
        seconds = rng.integers(0, span // step, rows) * step
    else:
        seconds = np.sort(rng.choice(span, rows, replace=False))
    share = None
    if hot:
        share = [hot] + [(1 - hot) / (machines - 1)] * (machines - 1)
    frame = pd.DataFrame(
        {
            "machine_id": rng.choice([f"M{i}" for i in range(machines)], rows, p=share),
            "timestamp": pd.Timestamp("2024-03-01") + pd.to_timedelta(seconds, unit="s"),
            "seq": rng.permutation(rows),
            "a": rng.normal(50, 20, rows).round(3),
            "b": rng.normal(-5, 3, rows).round(3),
            "failure": rng.random(rows) < 0.08,
        }
    )
    for c in ("a", "b"):
        frame.loc[rng.random(rows) < gaps, c] = np.nan
    lone = pd.DataFrame(
        {
            "machine_id": ["S1", "S2"],
            "timestamp": pd.Timestamp("2024-03-02"),
            "seq": [rows, rows + 1],
            "a": [1.0, np.nan],
            "b": [2.0, 3.0],
            "failure": [True, False],
        }
    )
    return pd.concat([frame, lone], ignore_index=True)


def ordered(frame):
    frame = frame.sort_values(["machine_id", "timestamp", "seq"]).reset_index(drop=True)
    frame["us"] = frame["timestamp"].astype("datetime64[us]").astype("int64")
    return frame


def per_machine(frame, fn):
    """Apply ``fn(rows) -> list`` per machine and line the values up with ``ordered``."""
    out = []
    for _, g in frame.groupby("machine_id", sort=True):
        out.extend(fn(g.reset_index(drop=True)))
    return out


def lag(g, c, k):
    x = g[c].tolist()
    return [x[i - k] if i >= k else math.nan for i in range(len(x))]


def rolling(g, c, width, what):
    us, x = g["us"].tolist(), g[c].tolist()
    out = []
    for i in range(len(x)):
        inside = [x[k] for k in range(i + 1) if us[k] > us[i] - width and not math.isnan(x[k])]
        if what == "mean":
            out.append(np.mean(inside) if inside else math.nan)
        else:
            out.append(np.std(inside, ddof=1) if len(inside) > 1 else math.nan)
    return out


def ema(g, c, a):
    out, y = [], None
    for x in g[c]:
        y = x if y is None else a * x + (1 - a) * y
        out.append(y)
    return out


def target(g, hours):
    us, f = g["us"].tolist(), g["failure"].tolist()
    if len(us) == 1:
        return [int(f[0])]
    return [
        int(any(ff and u < v <= u + hours * HOUR for v, ff in zip(us, f))) for u in us
    ]


def fill(g, c, method="time"):
    us, x = g["us"].tolist(), g[c].tolist()
    at = us if method != "linear" else list(range(len(x)))
    good = [i for i in range(len(x)) if not math.isnan(x[i])]
    out = []
    for i in range(len(x)):
        if not math.isnan(x[i]):
            out.append(x[i])
            continue
        before = [k for k in good if k < i]
        after = [k for k in good if k > i]
        if method == "forward":
            out.append(x[before[-1]] if before else math.nan)
            continue
        same = [k for k in good if at[k] == at[i]]
        if same:
            out.append(x[same[-1]])
        elif before and after:
            p, q = before[-1], after[0]
            out.append(x[p] + (x[q] - x[p]) * (at[i] - at[p]) / (at[q] - at[p]))
        elif before or after:
            out.append(x[before[-1]] if before else x[after[0]])
        else:
            out.append(math.nan)
    return out


def ema_with_gaps(g, c, a):
    out, y, gap = [], None, 0
    for x in g[c]:
        gap += 1
        if not math.isnan(x):
            old = (1 - a) ** gap
            y = x if y is None else (old * y + a * x) / (old + a)
            gap = 0
        out.append(math.nan if y is None else y)
    return out
