"""The analytic definitions as plain loops over one short history: the slow, obvious way."""

import math

SPANS = (5, 10, 22, 45, 90)


def slope(y):
    n = len(y)
    mx, my = (n - 1) / 2, sum(y) / n
    sxx = sum((k - mx) ** 2 for k in range(n))
    return sum((k - mx) * (v - my) for k, v in enumerate(y)) / sxx


def newest_defined(xs, n):
    kept = [x for x in xs if x is not None]
    return kept[-n:] if len(kept) >= n else None


def rolling(xs, span, f):
    return [f(xs[k - span + 1 : k + 1]) if k >= span - 1 else None for k in range(len(xs))]


def mean(xs):
    return sum(xs) / len(xs)


def pstd(xs):
    m = mean(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))


def ema(xs, p):
    out, e = [], None
    for k, x in enumerate(xs):
        if k == p - 1:
            e = mean([v or 0.0 for v in xs[:p]])
        elif k >= p and x is not None:
            e = x * 2 / (p + 1) + e * (1 - 2 / (p + 1))
        out.append(e)
    return out


def rsi(xs, p=14):
    steps = [b - a for a, b in zip(xs, xs[1:])]
    g, l = mean([max(s, 0) for s in steps[:p]]), mean([max(-s, 0) for s in steps[:p]])
    out = [None] * p
    for s in [None, *steps[p:]]:
        if s is not None:
            g, l = (g * (p - 1) + max(s, 0)) / p, (l * (p - 1) + max(-s, 0)) / p
        out.append(100.0 if l == 0 else 100 - 100 / (1 + g / l))
    return out


def streak(xs):
    steps = [(b > a) - (b < a) for a, b in zip(xs, xs[1:])]
    last, count = steps[-1], 0
    for s in reversed(steps):
        if s != last or last == 0:
            break
        count += 1
    return last * count


def metrics(bars):
    """bars: ascending list of (high, low, close, volume), at most 200."""
    close, vol = [b[2] for b in bars], [b[3] for b in bars]
    spread = [b[0] - b[1] for b in bars]
    out = {"streak": streak(close)}
    for name, xs in (("close", close), ("volume", vol)):
        for s in SPANS:
            k = 5 if s == 5 else 10
            avg = rolling(xs, s, mean)
            dev = [x / a - 1 if a else None for x, a in zip(xs, avg)]
            out[f"{name}_slope_{s}"] = slope(xs[-s:])
            out[f"{name}_sma_{s}"] = avg[-1]
            out[f"{name}_sma_slope_{s}"] = slope(newest_defined(avg, k))
            seen = newest_defined(dev, 1)
            out[f"{name}_dev_{s}"] = seen[0] if seen else None
            enough = newest_defined(dev, k)
            out[f"{name}_dev_slope_{s}"] = slope(enough) if enough else None
    for s in SPANS:
        std = rolling(spread, s, pstd)
        out[f"range_std_{s}"] = std[-1]
        out[f"range_std_slope_{s}"] = slope(newest_defined(std, 5 if s == 5 else 10))
    r = rsi(close)
    out["rsi_14"], out["rsi_slope_22"] = r[-1], slope(newest_defined(r, 22))
    line = [a - b if a is not None and b is not None else None for a, b in zip(ema(close, 12), ema(close, 26))]
    out["macd"], out["macd_slope_22"] = line[-1], slope(newest_defined(line, 22))
    out["macd_signal"] = ema(line, 9)[-1]
    return out
