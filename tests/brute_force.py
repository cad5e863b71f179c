"""Plain-Python clustering, all pairs, straight from the definition."""

import math
import re
import unicodedata
from collections import Counter


def words(text):
    folded = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return re.findall(r"(?u)\b\w\w+\b", folded)


def _vectors(texts):
    counts = []
    for text in texts:
        tokens = words(text)
        counts.append(Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]))
    df = Counter(g for c in counts for g in c)
    out = []
    for c in counts:
        w = {g: tf * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, tf in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        out.append({g: x / norm for g, x in w.items()})
    return out


def cluster(rows, threshold):
    """rows: (bucket, order, id, text) -> {id: leader id}"""
    buckets = {}
    for row in sorted(rows):
        buckets.setdefault(row[0], []).append(row)
    led = {}
    for members in buckets.values():
        vectors = _vectors([m[3] for m in members])
        leaders = []
        for i, (_, _, name, _) in enumerate(members):
            for j in leaders:
                small, large = sorted((vectors[i], vectors[j]), key=len)
                if sum(w * large.get(g, 0.0) for g, w in small.items()) >= threshold:
                    led[name] = members[j][2]
                    break
            else:
                leaders.append(i)
                led[name] = name
    return led
