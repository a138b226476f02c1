import random

from tidemark.llm.decontaminate import Items, LeakConfig, best_match, contaminated, find_leaks, plain_words


def table_distance(a, b):
    """Least edit distance of a to any run of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_best_match_equals_table():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randint(1, 4) for _ in range(rng.randint(1, 12))]
        b = [rng.randint(1, 4) for _ in range(rng.randint(0, 20))]
        assert best_match(a, b)[0] == table_distance(a, b)


def items(rng, n=30):
    return [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(8, 40)))) for k in range(n)]


def test_recall_over_all_allowed_edits():
    rng = random.Random(7)
    bench = items(rng)
    search = Items(bench, LeakConfig())
    found = total = 0
    for _ in range(300):
        k, text = rng.choice(bench)
        words = text.split()
        for _ in range(rng.randint(0, int(0.2 * len(words)))):
            p = rng.randrange(len(words))
            words[p:p + rng.randint(0, 1)] = [f"zz{rng.random()}"] * rng.randint(0, 1)
        doc = " ".join([f"x{i}" for i in range(rng.randint(0, 30))] + words + ["y"] * rng.randint(0, 9))
        near = table_distance(text.split(), doc.split()) <= int(0.2 * len(text.split()))
        total += near
        found += near and any(x["item_id"] == k for x in search.search([doc])[0])
    assert total > 150 and found >= 0.95 * total


def test_exact_against_all_runs(spark, make_docs):
    rng = random.Random(9)
    bench = items(rng, 12)
    docs = []
    for k in range(60):
        words = [f"w{rng.randint(0, 400)}" for _ in range(60)]
        if k % 3 == 0:
            words[20:20] = bench[k % 12][1].upper().split()
        docs.append((k, " ".join(words) + ".", "s"))
    docs += [(100, None, "s"), (101, "", None), (102, bench[0][1], "s"), (102, bench[0][1], "s")]
    bench_df = spark.createDataFrame([*bench, (50, None), (51, "!!"), (52, bench[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(make_docs(docs, "leaks"), bench_df).collect()}
    want = {(i, b) for i, t, _ in docs for b, x in [*bench, (52, bench[0][1])]
            if t and table_distance(plain_words(x), plain_words(t)) <= int(0.2 * len(plain_words(x)))}
    assert got == want and (102, 52) in got
    assert find_leaks(make_docs(docs, "leaks"), bench_df).count() == len(docs)
    assert contaminated(make_docs([]), bench_df).count() == 0
    assert contaminated(make_docs(docs), bench_df.limit(0)).count() == 0


def test_recall_of_long_items_at_the_allowed_edits():
    rng = random.Random(7)
    for width, n in ((120, 60), (300, 25)):
        items, docs = [], []
        for k in range(n):
            words = [f"q{k}x{i}" for i in range(width)]
            gone = set(rng.sample(range(width), width // 5))
            pad = [f"pad{rng.randrange(10**9)}" for _ in range(60)]
            items.append((k, " ".join(words)))
            docs.append(" ".join([*pad[:30], *(w for i, w in enumerate(words) if i not in gone), *pad[30:]]))
        found = Items(items, LeakConfig()).search(docs)
        assert sum(any(x["item_id"] == k for x in found[k]) for k in range(n)) >= 0.98 * n


def test_many_texts_are_searched_in_bounded_parts(monkeypatch):
    import random

    from tidemark.llm import decontaminate as dec

    rng = random.Random(3)
    items = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(30))) for k in range(5)]
    texts = [None, "", *(f"a b {items[k % 5][1]} c {k}" if k % 3 == 0 else f"plain text {k}" for k in range(60)), "x" * 5000]
    found = dec.Items(items, dec.LeakConfig())
    want, sizes, search = found.search(texts), [], dec.Items.search

    def watched(self, part):
        sizes.append((len(part), sum(len(t or "") for t in part)))
        return search(self, part)

    monkeypatch.setattr(dec, "SEARCH_CHARS", 600)
    monkeypatch.setattr(dec, "EMBED_WINDOWS", 3)
    monkeypatch.setattr(dec.Items, "search", watched)
    assert list(found.search_all(texts)) == want and sum(map(bool, want)) == 20
    assert sum(n for n, _ in sizes) == len(texts) and all(size <= 600 or n == 1 for n, size in sizes)
    assert list(found.search_all([])) == []


def test_windows_with_too_few_pairs_of_items_are_not_embedded(monkeypatch):
    from tidemark.llm import decontaminate as dec

    rng = random.Random(9)
    bench = [(k, " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(10, 70)))) for k in range(12)]
    search, embedded, embed = dec.Items(bench, LeakConfig()), [], dec.embed_keys

    def watched(flat, start, *rest):
        embedded.append(len(start))
        return embed(flat, start, *rest)

    monkeypatch.setattr(dec, "embed_keys", watched)
    # Runs of three words of each item, far from all of it.
    words = [x.split() for _, x in bench]
    assert search.search([" ".join(f"other{k} {' '.join(x[3:6])} more{k}" for k, x in enumerate(words))] * 50) == [[]] * 50
    assert not embedded
    # The most edits that are allowed, spread so that each breaks two pairs.
    for k, x in enumerate(words):
        edits = len(x) // 5
        changed = ["other" if i % 4 == 2 and i // 4 < edits else w for i, w in enumerate(x)]
        assert changed.count("other") == min(edits, (len(x) + 1) // 4)
        embedded.clear()
        search.search([" ".join(["before", *changed, "after"])])
        assert sum(embedded)


def test_words_are_the_plain_words():
    rng = random.Random(4)
    search = Items([(1, "Alpha, beta gamma! «delta» x-y")], LeakConfig())
    for _ in range(200):
        text = " ".join(rng.choice(["ALPHA", "beta", "--", "gamma", "(Delta)", "X-Y", "\u00a0", "İ", "other", "'", ""]) for _ in range(rng.randint(0, 12)))
        assert search.ids(text).tolist() == [search.vocabulary.get(w, 0) for w in plain_words(text)]
