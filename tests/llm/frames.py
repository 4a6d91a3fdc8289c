"""Small frames with the awkward cases that every operator must take."""

LONG = " ".join(f"word{i % 977} item{i % 31}" for i in range(30_000))


def documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names clash with inner ones."""
    texts = ["", None, "One line.", "One line.", LONG, "a\nb\na\n\n", "   \n\t", "naïve café ☕ Σας", "x" * 5000]
    rows = [(i, t, "en", None, i, "lbl", 1, "r", b"k") for i, t in enumerate(texts)]
    rows += [rows[2], (None, "no id", None, None, None, None, None, None, None), (3, "other text, same id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string, rank int, rules string, key binary")


def empty(spark, frame):
    return frame.limit(0)
