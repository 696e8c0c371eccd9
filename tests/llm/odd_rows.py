"""Tables with every odd kind of row, for all corpus operators."""


def odd_documents(spark, texts):
    """Rows that try an operator: nulls in any column, empty, long, repeated and clashing ones."""
    rows = [(k, t, None if k % 7 else "en", None, None, k, 1.5) for k, t in enumerate(texts)]
    base = len(rows)
    rows += [(base, None, "en", "s", 0, 0, 0.0), (base + 1, "", "en", "s", 0, 0, None)]
    rows += [(base + 2, "a", None, None, 1, None, None), (base + 3, " \n\t ", None, None, 4, None, None)]
    rows += [(base + 4, "word " * 60_000, None, None, None, None, None)]
    rows += [rows[0], rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, piece int, score double"
    return spark.createDataFrame(rows, schema)


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
