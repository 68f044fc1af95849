"""Small documents with nulls, ties, repeats, long texts and clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, _n int"


def odd_documents(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
    rows = [
        (1, "one two three", "en", "a", 13, "x", "y", 0), (1, "one two three", "en", "a", 13, "x", "y", 0), (2, "", "en", "a", 0, None, None, None), (3, None, None, None, None, None, None, None),
        (None, "four\tfive six", "fr", "b", 13, "x", "y", 1), (4, long, "en", "b", len(long), "x", "y", 1), (5, "password = hunter2222 AKIA" + "Q" * 20, "en", None, 1, "x", "y", 1),
        (6, "é" * 5 + ' "api_key": "abc123def456" ' + "0a" * 15, "de", "c", 1, "x", "y", 1), (7, "token: a, secret: token = abcdefgh; TOKEN='0123456789abcdef01234567'", "en", "c", 1, "x", "y", 1),
        (8, "token: a, secret: token = abcdefgh; TOKEN='0123456789abcdef01234567'", "en", "d", 1, "x", "y", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)
