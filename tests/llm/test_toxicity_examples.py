from matchlake.llm import toxicity as T


def test_one_map_gives_all_examples(spark):
    """Texts and their misspelt copies come from one Python map: two in a row hold two workers a task."""
    lexicon = T.Lexicon(["hateword", "vilespeech"], ["nastyr"])
    texts = [(1, "You HATEWORD and vilespeech"), (0, "a hateword here"), (1, "nothing at all"), (1, ""), (0, "nastyroot")]
    rows = T._examples(spark.createDataFrame(texts, "toxic int, t string"), lexicon)
    assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = []
    for y, text in texts:
        copies = [T.misspelt(text, lexicon, n) for n in (1, 2)] if y else []
        want += [(y, T.features(t, lexicon)) for t in (text, *[c for c in copies if c != text.lower()])]
    assert len(want) == 7 and sorted((r.toxic, r.value) for r in rows.collect()) == sorted(want)
