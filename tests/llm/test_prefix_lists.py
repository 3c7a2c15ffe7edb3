"""Which entries of a shingle's list op10 keeps, and how long the sketches are that entries carry."""

import numpy as np

from millrace.llm import op10_jaccard_groups
from millrace.llm.columns import bound_batches, id_and_text
from millrace.llm.blocks import store_blocks
from millrace.session import ship_package


def may_pair(n, p, m, q, percent):
    return 100 * min(n, m) >= percent * max(n, m) and (100 + percent) * min(n - p, m - q) >= percent * (n + m)


def test_entries_of_pairs_stay_and_those_without_room_go():
    rng = np.random.default_rng(1)
    dropped = 0
    for _ in range(200):
        size, percent = int(rng.integers(1, 40)), int(rng.integers(50, 101))
        token, n = rng.integers(0, 6, size).astype(np.uint64), rng.integers(1, 60, size)
        place = (rng.random(size) * n * (100 - percent) / 100).astype(np.int64)
        order = np.lexsort((n, token))
        token, n, place = token[order], n[order], place[order]
        stay = op10_jaccard_groups._may_lead(token, n, place, percent)
        for i in range(size):
            mates = [j for j in range(size) if j != i and token[j] == token[i]]
            if any(may_pair(n[i], place[i], n[j], place[j], percent) for j in mates):
                assert stay[i]
            if not any(100 * min(n[i], n[j]) >= percent * max(n[i], n[j]) for j in mates):
                assert not stay[i]
        dropped += int((~stay).sum())
    assert dropped
    assert op10_jaccard_groups._may_lead(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 85).tolist() == []


def test_a_shared_shingle_far_back_in_a_prefix_makes_no_entry(spark):
    """Two sets that share only their most frequent prefix shingle cannot be similar, so no list holds them."""
    ship_package(spark)
    bound_batches(spark)
    own = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    rows = [(i, f"{own[i]} one two three four") for i in range(2)]
    blocks = store_blocks(id_and_text(spark.createDataFrame(rows, "doc_id bigint, text string")), [])
    # Counts put the shared shingle at the last place of both prefixes.
    shared = set(sets(rows[0][1])) & set(sets(rows[1][1]))
    ranks = np.zeros(op10_jaccard_groups.COUNTERS, np.uint16)
    for text in (rows[0][1], rows[1][1]):
        items = np.array(sorted(sets(text)), np.uint64)
        length = items.size - -(-85 * items.size // 100) + 1
        others = [x for x in items.tolist() if x not in shared]
        for x in others[length - 1 :]:
            ranks[x & (op10_jaccard_groups.COUNTERS - 1)] = 9
    for x in shared:
        ranks[x & (op10_jaccard_groups.COUNTERS - 1)] = 5
    links = op10_jaccard_groups._prefix_lists(blocks, ranks, 4, 85)
    assert links.where("token IS NOT NULL").count() == 0
    assert links.where("sig IS NOT NULL").count() == 2


def sets(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return next(op10_jaccard_groups.shingle_sets(data, np.array([0, data.size]), 4))[1].tolist()


def test_carried_sketches_hold_at_most_a_cell_per_item():
    for size in (1, 63, 64, 300, 5000, 40000):
        items = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size).astype(np.uint64))
        carried = op10_jaccard_groups.carried_sketch(items)
        assert carried.size <= max(1, min(64, items.size // 64))
        assert carried.tolist() == op10_jaccard_groups.parity_sketch(items, carried.size).tolist()
