"""Small corpora for the operators' tests."""

import random

# Names that operators use inside, as further columns of the input.
CLASHING = "id text_ n hash owner doc key score unit component line batch bucket bin_id".split()

WORDS = "the of and tion ing house river stone light green walks under over again paper".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


def edge_texts():
    """Null, empty, blank, tiny, multilingual, special strings, very long with and without blanks."""
    rng = random.Random(7)
    return [
        None,
        "",
        " \n\t ",
        "word",
        "Two WORDS",
        "l'été déjà vu, naïve café; 日本語のテキスト ☃ \U0001f600",
        "a<|endoftext|>b <|endo",
        "x" * 20_000,
        " " * 3_000 + "end",
        prose(rng, 6_000),
        "same line of text\nSAME line of text \n\tother line here\n\n\nsame line of text",
        prose(rng, 60),
        "# * $ % & | < > " * 40,
        "again " * 300,
    ]


def edge_documents(spark, texts=None):
    """The texts twice under one id each, once more under null ids, among clashing columns."""
    texts = edge_texts() if texts is None else texts
    rows = [(i, t, "s", i) for i, t in enumerate(texts)]
    rows += [(i, t, "s", i) for i, t in enumerate(texts)]
    rows += [(None, t, None, None) for t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    extra = {c: frame["n_chars"] for c in CLASHING}
    return frame.withColumns(extra)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")


def near_copies(rng, groups=12, copies=6, words=120):
    """Texts and edited copies of them, some exact, some just under the threshold."""
    texts = []
    for _ in range(groups):
        base = prose(rng, rng.choice([3, 5, 9, 20, words, 4 * words])).split()
        for _ in range(copies):
            edited = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 40, len(base) // 25])):
                edited[rng.randrange(len(edited))] = prose(rng, 1)
            texts.append(" ".join(edited))
    shared = prose(rng, 60)
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, rng.choice([5, 40])) for _ in range(20)]
    return texts
