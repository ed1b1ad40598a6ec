"""Plain versions of operators, one row at a time."""

import hashlib
import math
import re
from collections import Counter

ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")


def entropy(window: str) -> float:
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def secrets(text, allowed, width=20):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    base = sorted(spans)
    for m in TOKEN.finditer(text):
        s = m[0]
        if len(s) < 20 or not re.search("[A-Za-z]", s) or not re.search("[0-9]", s):
            continue
        if any(re.search(p, s) for p in allowed):
            continue
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", s):
            bar = 3.0
        elif re.fullmatch("[0-9a-z]+|[0-9A-Z]+", s):
            bar = 3.5
        else:
            bar = 3.8
        high = [i for i in range(len(s) - width + 1) if entropy(s[i : i + width]) >= bar]
        if high:
            spans.append((m.start() + high[0], 3, m.start() + high[-1] + width))
    names = ("assign", "access", "hex", "entropy")
    said = lambda xs: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(xs))
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], hashlib.sha256(said(base).encode()).hexdigest(), said(spans), n[3]
