def test_space_is_fitted_on_every_document(spark, monkeypatch):
    """op9, pipeline: all texts reach the fit, none is drawn."""
    from paxflow.llm import decontaminate as d

    seen = []
    fit = d.fit_space
    monkeypatch.setattr(d, "fit_space", lambda items, rows, *a: (seen.append(rows.count()), fit(items, rows, *a))[1])
    docs = spark.range(2500).selectExpr("id as doc_id", "concat('alpha beta gamma delta ', id) as text")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta omega. The answer is here.")], "item_id long, text string")
    d.contaminated(docs, bench)
    assert seen == [2500]


def test_products_do_not_depend_on_the_chunks(spark, monkeypatch):
    import numpy as np

    from paxflow.llm import decontaminate as d

    items = d.read_items([(1, "a b c d e f g h " * 9), (2, "b c x y z. e f")])
    docs = spark.createDataFrame([(1, "a b c x y z q " * 30), (2, "e f g")], "id long, text string")
    frequencies, n = d.document_frequencies(docs)
    whole = d.fit_space(items, docs, frequencies, n)
    monkeypatch.setattr(d, "CHUNK_WORDS", 5)
    small = d.fit_space(items, docs, frequencies, n)
    assert np.allclose(whole.items @ whole.items.T, small.items @ small.items.T, rtol=1e-3)


def test_documents_are_read_once_for_the_fit_and_once_for_the_search(spark):
    """op9: frequencies and every round of the fit come from one reading."""
    from paxflow.llm import decontaminate as d

    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.range(300).selectExpr("id as doc_id", "concat('alpha beta gamma delta ', id) as text")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta omega. The answer is here.")], "item_id long, text string")
    d.contaminated(docs.mapInArrow(watched, docs.schema), bench).collect()
    assert read.value == 600


def test_pairs_of_words_are_counted_as_written(monkeypatch):
    import random

    import numpy as np
    import pyarrow as pa

    from paxflow.llm import decontaminate as d
    from paxflow.llm.words import Splitter

    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.choice([0, 1, 23, 24, 25, 130]))) for _ in range(40)]
    splitter = Splitter(lower=True, letters_only=True)
    vocabulary = np.unique(splitter.split(pa.array(["a b c d e f g"])).hash)
    places = {w: k for k, w in enumerate(vocabulary.tolist())}
    wanted = np.zeros((7, 7), int)
    for text in texts:
        codes = [places.get(h) for h in splitter.split(pa.array([text])).hash.tolist()]
        for at in range(0, len(codes), d.SHORT * d.STEP):
            passage = [c for c in codes[at : at + d.SHORT * d.STEP] if c is not None]
            for a in passage:
                for b in passage:
                    wanted[a, b] += 1
    # a task that holds few keys, lets go of them often and deals them over many blocks
    monkeypatch.setattr(d, "PAIR_KEYS", 50)
    monkeypatch.setattr(d, "PAIRS_HELD", 60)
    monkeypatch.setattr(d, "PAIR_CELLS", 16)
    pairs, found = d.Pairs(vocabulary), np.zeros(49, int)
    for text in [*texts, None]:
        if text is not None:
            pairs.add(splitter.split(pa.array([text])))
        if text is None or pairs.full():
            for block, packed in pairs.take():
                keys, counts = d.unpack(packed)
                found[keys + block * d.rows_of_block(7) * 7] += counts
    assert (found.reshape(7, 7) == wanted).all()


def test_products_in_one_thread_are_the_same(monkeypatch):
    import numpy as np

    from paxflow.llm import decontaminate as d

    rng = np.random.default_rng(1)
    left, right = rng.standard_normal((37, 8)), rng.standard_normal((5, 8))
    for most in (1, 100, 1 << 18):
        monkeypatch.setattr(d, "ONE_THREAD", most)
        assert np.allclose(d.products(left, right), left @ right.T)
    assert d.products(left[:0], right).shape == (0, 5)
