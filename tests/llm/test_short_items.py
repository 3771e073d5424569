from colloquy.llm import decontaminate


def test_items_of_few_words_are_found_word_for_word(spark):
    docs = spark.createDataFrame(
        [
            (1, "some text where Alpha, beta gamma! stands among many other words of a longer document"),
            (2, "alpha beta without the third word in a document that is long enough"),
            (3, "alpha beta gamma"),
            (4, "gamma beta alpha and then more words to come"),
            (5, "what is one plus one in the year twenty twenty"),
            (6, "alpha beta"),
        ],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(10, "alpha beta gamma"), (11, "one"), (12, "what is one plus one in the year"), (13, None), (14, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 10): (1.0, 3, 3), (3, 10): (1.0, 0, 3), (5, 11): (1.0, 2, 1), (5, 12): (1.0, 0, 8)}
