"""Rare words of toxic documents are enough to reject them."""

import random

from veriframe.llm import importance


def test_rare_insults(spark):
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rnd.randrange(400)}" for _ in range(80)]
        if toxic := i % 8 == 0:
            words[rnd.randrange(80)] = f"insult{i // 8 % 3}"
        docs.append((i, " ".join(words), "ab"[i % 2 if not toxic else i // 8 % 2]))
        labels.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = importance.toxic_recall(docs, labels, "lang").collect()
    assert len(found) == 2 and sum(r.toxic for r in found) > 20
    assert sum(r.caught for r in found) >= 0.9 * sum(r.toxic for r in found)
    assert sum(r.lost for r in found) <= 3
