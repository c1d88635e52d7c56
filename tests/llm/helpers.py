"""Small inputs and plain-Python versions of the operators."""

import hashlib
import re

DOC = "doc_id long, text string"


def documents(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def write(df, folder, table):
    df.coalesce(2).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def shingles(text, k=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def smallest_reachable(nodes, links):
    near = {n: {n} for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[n] = min(seen)
    return out


def removed_bytes(texts, length):
    """Positions covered by a string that also starts elsewhere."""
    places = {}
    for key, text in texts.items():
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            places.setdefault(data[i : i + length], []).append((key, i))
    gone = {key: set() for key in texts}
    for found in places.values():
        if len(found) > 1:
            for key, i in found:
                gone[key].update(range(i, i + length))
    return gone


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
