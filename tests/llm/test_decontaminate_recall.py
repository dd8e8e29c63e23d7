from itertools import combinations

import pytest

from martlight.llm import decontaminate


@pytest.mark.parametrize("size", range(1, 14))
def test_masks_hit_every_overlap(size):
    masks = decontaminate.masks_for(size)
    for changes in range(size):
        if (size - changes) / size >= 0.8:
            for changed in combinations(range(size), changes):
                assert any(not {at + n for n in mask} & set(changed) for mask in masks for at in range(size - mask[-1]))


def test_every_overlap_is_found(spark):
    items, docs, want = [], [], {}
    for size in range(1, 21):
        item = [f"i{size}w{n}" for n in range(size)]
        items.append((size, " ".join(item)))
        window = min(13, size)
        changes = max(c for c in range(window) if (window - c) / window >= 0.8)
        for changed in combinations(range(window), changes):
            words = [f"x{n}" if n in changed else w for n, w in enumerate(item)]
            want[len(docs), size] = 1
            docs.append((len(docs), "before " + " ".join(words) + " after"))
        if changes + 1 < window:
            worse = [f"x{n}" if n * window // size % 2 else w for n, w in enumerate(item)]
            docs.append((len(docs), " ".join(worse)))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.doc_start for r in found.collect()} == want
