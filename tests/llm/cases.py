"""Awkward documents and plain versions of the operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
FIELDS = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
#: Names that the operators use inside, as extra columns of the input.
CLASHING = [(c, T.StringType()) for c in ("size", "target", "score", "node", "key", "sid", "label", "part", "kind", "shard", "group", "copies", "_place")]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in FIELDS + CLASHING])


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), *("x" for _ in CLASHING))


PROSE = "the cat sat on the mat and the dog lay by the door of the house while it rained all day long"
AWKWARD = [
    document(1, None), document(2, ""), document(3, " \n\t "), document(4, PROSE), document(4, PROSE), document(5, PROSE.upper()),
    document(6, LONG, "en", "b"), document(7, "!!! 123", None, None), document(8, PROSE + " once more", "de", None), document(9, "one"),
    document(10, "one"), document(11, "Ünïcödé ßtraße 中文 no break <|endoftext|> end", "fr", "c"), document(None, PROSE, None, "b"),
    document(12, "x" * 5000, "es", "c"), document(13, None, None, None),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def fold(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def shingles(text, size):
    words = re.findall(WORD, fold(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(texts, size, percent):
    """{id: (shingles, component)} of {id: text}."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holding = defaultdict(list)
    links = []
    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in holding[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                links.append((i, j))
        for s in sets[i]:
            holding[s].append(i)
    found = components(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}
