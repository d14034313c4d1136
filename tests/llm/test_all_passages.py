"""Every passage above the threshold is verified, not only the one that scores best."""

import random

from textloom.llm import decontaminate


def test_a_passage_with_the_same_words_does_not_hide_the_copy(spark):
    rng = random.Random(5)
    item = "which river runs north of the old mill ? the thorn"
    words = item.replace("? ", "").split()
    filler = " ".join(f"f{i}" for i in range(1000))
    apart = words[:]
    while any(apart[k : k + 2] == words[i : i + 2] for i in range(9) for k in range(9)):
        rng.shuffle(apart)
    scattered = " ".join(f"{w} x{i} y{i}" for i, w in enumerate(apart))
    docs = [(1, f"{scattered} {filler} {item} {filler}"), (2, f"{scattered} {filler}"), (3, f"{filler} {item}")]
    bench = spark.createDataFrame([(7, item), (8, "what else is there ? nothing more")], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 7), (3, 7)}
    assert all(r.start >= 800 for r in got)
