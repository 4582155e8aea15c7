import random
from collections import Counter, defaultdict

import numpy as np

from fieldglass.llm import similar, simhash

from .fixtures import documents, empty


def slow_set(text, k=5):
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def alike(a, b, similarity=0.8):
    return a == b or len(a & b) >= similarity * len(a | b) - 1e-9


def slow_classes(docs, similarity=0.8):
    """For each row its class's smallest id, by looking at all pairs of different sets."""
    sets = [slow_set(t) for _, t in docs]
    up = {s: s for s in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    different = list(up)
    for i, a in enumerate(different):
        for b in different[:i]:
            if min(len(a), len(b)) >= similarity * max(len(a), len(b)) and alike(a, b, similarity):
                up[top(a)] = top(b)
    least = {}
    for (i, _), s in zip(docs, sets, strict=True):
        if i is not None:
            least[top(s)] = min(i, least.get(top(s), i))
    return [(i, least.get(top(s))) for (i, _), s in zip(docs, sets, strict=True)]


def key(x):
    return tuple((v is None, v or 0) for v in x)


def check(spark, docs, similarity=0.8):
    got = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs, similarity=similarity).collect()]
    assert sorted(got, key=key) == sorted(slow_classes([(r["doc_id"], r["text"]) for r in docs.collect()], similarity), key=key)


def made(rng, clusters=25):
    """Texts of many lengths with copies that differ in some words, chains of them, and texts that share a long passage only."""
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = []
    for c in range(clusters):
        n = rng.choice((3, 5, 6, 9, 14, 30, 60, 120, 250, 700))
        own = [rng.choice(words) for _ in range(n)]
        for _ in range(rng.randint(1, 9)):
            texts.append(" ".join(own))
            for _ in range(rng.choice((0, 1, 1, 2, n // 50 + 1, n // 12 + 1))):
                own = list(own)
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own[: -rng.randint(1, 3)] or own
        if c % 4 == 0:
            texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(8)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_classes_are_those_of_all_pairs(spark):
    for seed, similarity in ((1, 0.8), (2, 0.8), (3, 0.9)):
        check(spark, frame(spark, made(random.Random(seed))).repartition(3), similarity)


def test_odd_rows(spark):
    check(spark, documents(spark))
    assert simhash.near_duplicates(empty(spark)).collect() == []
    check(spark, frame(spark, [(1, "a b c d e f g " * 40_000), (2, "a b c d e f g " * 40_000 + "x"), (3, "x" * 200_000), (4, None), (None, " ")]))


def test_many_near_copies_of_one_text(spark):
    """One class with most rows: exact copies, and near copies that are all alike."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    near = [" ".join([*base[:i], f"n{i}", *base[i + 1 :]]) for i in range(150)]
    rows = [(i, " ".join(base)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(near)] + [(5000 + i, " ".join(f"r{rng.random()}" for _ in range(100))) for i in range(50)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert all(got[i] == 0 for i, _ in rows if i < 5000) and all(got[i] == i for i, _ in rows if i >= 5000)
    kept = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, *range(5000, 5050)]


def test_shingles_and_prints():
    rng = random.Random(0)
    texts = [None, "", " \t", "a", "a b c", "A  B\nC", "x " * 50, *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 200))) for _ in range(80))]
    shingles, counts = similar.shingle_sets(texts, 5, similar.WordHashes())
    ends, sets = np.cumsum(counts), [slow_set(t) for t in texts]
    assert counts.tolist() == list(map(len, sets))
    own = [set(shingles[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)]
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            assert len(own[i] & own[j]) == len(sets[i] & sets[j])
    ids = similar.set_ids(shingles, counts)
    assert len(set(ids.tolist())) == len(set(sets)) and ids[0] == ids[1] == ids[2] == similar.EMPTY
    prints = similar.wide_prints(shingles, counts)
    for i in (3, 6, 7, 30):
        for word in range(similar.WIDE):
            hashes = similar.mixed(np.array(sorted(own[i]), np.uint64), 20 + word).tolist()
            assert int(prints[i, word]) == sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_similar_sets_share_a_part():
    """Pairs just above 0.8, of many sizes: nearly all share a key, and their fingerprints are near enough."""
    rng, vocabulary = random.Random(0), [f"w{i}" for i in range(5000)]
    pairs = shared = near = 0
    for n in (85, 100, 127, 130, 180, 255, 500, 1020):
        texts = []
        for _ in range(60):
            words = [rng.choice(vocabulary) for _ in range(n)]
            a, b = slow_set(" ".join(words)), list(words)
            while True:
                other = list(b)
                other[rng.randrange(n)] = rng.choice(vocabulary)
                if not alike(a, slow_set(" ".join(other))):
                    break
                b = other
            texts += [" ".join(words), " ".join(b)]
        shingles, counts = similar.shingle_sets(texts, 5, similar.WordHashes())
        keys = defaultdict(set)
        for i, k in zip(*map(np.ndarray.tolist, similar.part_keys(shingles, counts, 0.8)), strict=True):
            keys[i].add(k)
        prints = similar.wide_prints(shingles, counts)
        pairs += 60
        shared += sum(bool(keys[2 * i] & keys[2 * i + 1]) for i in range(60))
        bits = np.bitwise_count(prints[::2] ^ prints[1::2]).sum(axis=1)
        near += int((bits <= similar.allowed_bits(similar.most_bits(0.8), counts[::2], counts[1::2])).sum())
    assert shared == pairs and near == pairs


def test_bounds_for_sets_of_all_sizes():
    """Sets of random shingles that are just as similar as they must be: no fingerprints are farther apart than allowed."""
    rng, table = np.random.default_rng(1), similar.most_bits(0.8)
    for m in [*range(1, 40), 64, 100, 255, 256, 257, 300, 513, 1000]:
        for n in sorted({m, m + 1, int(m / 0.8 + 1e-9)}):
            common = int(np.ceil(0.8 * (m + n) / 1.8 - 1e-9))
            if common > m or n < m or n * 0.8 > m + 1e-9:
                continue
            pool = rng.integers(0, 2**55, (30, m + n - common), dtype=np.uint64)
            flat = np.concatenate([x for row in pool for x in (row[:m], np.concatenate([row[:common], row[m:]]))])
            counts = np.tile([m, n], 30)
            prints = similar.wide_prints(flat, counts)
            bits = np.bitwise_count(prints[::2] ^ prints[1::2]).sum(axis=1)
            assert (bits <= similar.allowed_bits(table, counts[::2], counts[1::2])).all(), (m, n)


def test_short_pairs_all_link(spark):
    """Pairs of 4 to 30 shingles whose similarity is 0.8 or just above, by cutting words off or changing them at an end."""
    rng, texts = random.Random(3), []
    for size in range(4, 31):
        for _ in range(12):
            words = [f"v{rng.randrange(10**6)}" for _ in range(size + 4)]
            other = list(words)
            while alike(slow_set(" ".join(words)), slow_set(" ".join(other[:-1]))):
                other = other[:-1]
            changed = [*words[:-1], "changed"]
            texts.append((" ".join(words), " ".join(changed if alike(slow_set(" ".join(words)), slow_set(" ".join(changed))) and rng.random() < 0.5 else other)))
    rows = [(i, t) for i, t in enumerate(t for pair in texts for t in pair)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert all(got[2 * i + 1] == 2 * i for i, (a, b) in enumerate(texts))


def test_many_unlike_short_texts_of_one_opening(spark):
    """A hundred thousand short texts that begin alike don't meet in one task; near copies among them are found."""
    rows = [(i, f"dear reader this is to tell you that your order n{i} of a{i % 977} b{i * 31 % 1009} is under way") for i in range(100_000)]
    rows += [(200_000 + i, f"{rows[i * 997][1]} today") for i in range(100)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, rows).repartition(8)).collect()}
    assert all(got[200_000 + i] == i * 997 for i in range(100))
    assert sum(c == i for i, c in got.items()) == 100_000


def test_nearest_tree_keeps_what_pairs_link():
    rng = random.Random(4)
    prints = []
    for _ in range(8):
        p = [rng.getrandbits(64) for _ in range(similar.WIDE)]
        for _ in range(rng.randint(1, 12)):
            p = [w ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for w in p]
            prints.append(p)
    prints = np.array(prints, np.uint64)
    for most in (0, 7, 20, 60, 256):
        one, other, far = similar.nearest_tree(prints, most)
        for limit in range(0, most + 1, 5):
            groups = []
            for links in ([(a, b) for a, b, d in zip(one, other, far, strict=True) if d <= limit], [(a, b) for a in range(len(prints)) for b in range(a) if np.bitwise_count(prints[a] ^ prints[b]).sum() <= limit]):
                up = list(range(len(prints)))
                for a, b in links:
                    ra, rb = a, b
                    while up[ra] != ra:
                        ra = up[ra]
                    while up[rb] != rb:
                        rb = up[rb]
                    up[ra] = rb
                tops = []
                for x in range(len(prints)):
                    while up[x] != x:
                        x = up[x]
                    tops.append(x)
                groups.append(Counter(frozenset(i for i, t in enumerate(tops) if t == x) for x in set(tops)))
            assert groups[0] == groups[1]


def test_nearest_pairs_against_all_pairs():
    """Each fingerprint's nearest of another root within the bound, those that failed left out; with enough of them, all such pairs."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, (40, similar.WIDE), dtype=np.uint64)
    prints = base[rng.integers(0, 40, 300)]
    for i in range(300):
        for _ in range(rng.integers(0, 260)):
            prints[i, rng.integers(similar.WIDE)] ^= np.uint64(1) << np.uint64(rng.integers(64))
    sizes, root, table = rng.integers(60, 500, 300), rng.integers(0, 250, 300), similar.most_bits(0.8)
    failed = np.array([[1, 2, 5, 9], [2, 1, 9, 5]])
    differ = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2).astype(int)
    may = (differ <= similar.allowed_bits(table, *np.broadcast_arrays(sizes[:, None], sizes[None]))) & (root[:, None] != root[None])
    may[failed[0], failed[1]] = False
    for k in (1, 3, 300, 1000):
        one, other, bits = similar.nearest_pairs(prints, sizes, root, failed, table, k)
        got = {(min(a, b), max(a, b)) for a, b in zip(one.tolist(), other.tolist(), strict=True)}
        assert len(got) == len(one) and all(may[a, b] and differ[a, b] == c for a, b, c in zip(one, other, bits, strict=True))
        for i in range(300):
            near = np.flatnonzero(may[i])
            if len(near):
                limit = np.sort(differ[i][near])[min(k, len(near)) - 1]
                assert all((min(i, j), max(i, j)) in got for j in near.tolist() if differ[i, j] < limit)
                assert sum(i in pair for pair in got) >= min(k, len(near))
    assert similar.nearest_pairs(prints[:0], sizes[:0], root[:0], np.zeros((2, 0), np.int64), table, 3)[0].tolist() == []


def near_08(rng, n):
    """Texts of 150 words with some of them changed, so that of many pairs the similarity is a little above or below 0.8."""
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(2, 5)):
            words[rng.randrange(150)] = f"x{i}"
        out.append(" ".join(words))
    return out


def test_links_among_sets_are_those_of_all_pairs(monkeypatch):
    rng = random.Random(6)
    texts = near_08(rng, 80) + [t for _, t in made(rng, 6)]
    sets = [slow_set(t) for t in texts]
    for limit in (similar.WORDS_OF_SETS, 50):  # sets as bits, and as lists
        monkeypatch.setattr(similar, "WORDS_OF_SETS", limit)
        shingles, counts = similar.shingle_sets(texts, 5, similar.WordHashes())
        prints, lists = similar.wide_prints(shingles, counts), np.split(shingles, np.cumsum(counts)[:-1])
        for side in (np.zeros(len(texts), int), np.arange(len(texts)) % 2):
            one, other = similar.links_among(prints, lists, side, 0.8)
            groups = []
            for links in (zip(one.tolist(), other.tolist(), strict=True), [(a, b) for a in range(len(texts)) for b in range(a) if (side[a] != side[b] or not side.any()) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]):
                name = list(range(len(texts)))
                for a, b in links:
                    assert alike(sets[a], sets[b])
                    name = [name[a] if x == name[b] else x for x in name]
                groups.append(Counter(frozenset(i for i, x in enumerate(name) if x == y) for y in set(name)))
            assert groups[0] == groups[1]


def test_classes_in_blocks(spark, monkeypatch):
    """A group larger than a block: each two blocks meet."""
    monkeypatch.setattr(similar, "BLOCK", 16)
    check(spark, frame(spark, list(enumerate(near_08(random.Random(8), 120)))).repartition(3))


def test_no_more_jobs_for_pairs_that_fail(spark):
    """Near copies of which most pairs are not quite similar enough take no rounds of their own."""
    rng, jobs = random.Random(9), []
    for rows in ([(i, " ".join(f"r{rng.random()}" for _ in range(150))) for i in range(60)], list(enumerate(near_08(rng, 400)))):
        spark.sparkContext.setJobGroup(f"similar {len(rows)}", "")
        simhash.drop_near_duplicates(frame(spark, rows)).count()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"similar {len(rows)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= 220
