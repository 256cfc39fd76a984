"""Small documents with every awkward case, shared by the tests of the corpus operators."""

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns with names that the operators use inside.
EXTRA = "kept boolean, band bigint, node bigint, root bigint, hash bigint, row bigint, measures int, score string, ids int"

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards brew a mild potion near the old "
    "stone bridge and nobody in the village dares to ask what the smoke above the chimney might mean"
).split()


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang) as documents with clashing extra columns."""
    full = []
    for row in rows:
        doc_id, text, lang = (*row, "en")[:3]
        full.append((doc_id, text, lang, "s", None if text is None else len(text), *[None] * 9))
    return spark.createDataFrame(full, f"{DOCUMENT}, {EXTRA}")


def awkward_rows():
    long_text = " ".join(PROSE[(7 * i * i + i) % len(PROSE)] + str(i % 9973) for i in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "two words"),
        (6, " ".join(PROSE)),
        (7, " ".join(PROSE)),
        (7, " ".join(PROSE)),
        (8, long_text),
        (9, "éÉß 中文 🙂 ٣ Ω"),
        (None, "a text without an id"),
        (None, None),
        (10, "x" * 50_000),
        (11, "... !!! 123"),
    ]
