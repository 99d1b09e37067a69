"""Short items inside longer texts against the check at every place of the text."""

import random

import pyarrow as pa
from barloom.llm import decontamination

SF = "/root/testdata/sf0.01"


def test_short_items_are_found(spark):
    rng = random.Random(8)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text")
    texts = [decontamination_words(r.text) for r in docs.collect()]
    texts = [t for t in texts if len(t) > 150]
    base = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    long = [w for w in (decontamination_words(r.text) for r in base) if len(w) >= 20]
    for changed in (0, 1):
        want, got = {}, {}
        items, hosts = [], []
        for n in range(200):
            length = (5, 8, 10, 12, 15, 18)[n % 6]
            item = long[n % len(long)][:length]
            copy = list(item)
            if changed:
                for at in rng.sample(range(length), length // 5):
                    copy[at] = "changed"
            host, at = texts[n % len(texts)], rng.randint(20, 100)
            items.append((n, " ".join(item)))
            hosts.append((n, " ".join([*host[:at], *copy, *host[at:]])))
        frame = spark.createDataFrame(hosts, "doc_id long, text string")
        fitted = decontamination.fit(docs.union(frame), spark.createDataFrame(items, "item_id long, text string"))
        held = fitted.items(0)
        place = {i: k for k, i in enumerate(held.ids)}
        for w in decontamination.tokens.words(pa.array([t for _, t in hosts]), decontamination._NOT_WORD):
            for n in range(w.n_texts):
                key = w.key[w.text == n].tolist()
                doc, k = hosts[w.first + n][0], place[hosts[w.first + n][0]]
                length = len(held.keys[k])
                best = max(held.check(k, key[s : s + 2 * length + 8]) for s in range(len(key)) if s < 130)
                if best >= decontamination.COVERED:
                    want.setdefault(length, set()).add(doc)
        pairs = {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, fitted).collect()}
        for length, docs_of in want.items():
            got[length] = sum((d, d) in pairs for d in docs_of)
        print("changed" if changed else "verbatim", {k: (got[k], len(want[k])) for k in sorted(want)})
        total = sum(len(v) for v in want.values())
        assert total > 100 and sum(got.values()) >= (0.9 if changed else 1.0) * total


def decontamination_words(text):
    return [x.decode() for w in decontamination.tokens.words(pa.array([text]), decontamination._NOT_WORD) for x in (bytes(w.data[a:b]) for a, b in zip(w.start, w.end))]
