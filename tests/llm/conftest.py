"""Small document tables: as usual, and with all that a table may have that it shouldn't."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, schema: str = SCHEMA, sources=("web", "books", None)):
        """Texts, or (id, text) pairs, as a documents table."""
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", sources[k % len(sources)], len(t or "")) for k, (i, t) in enumerate(rows)], schema)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, columns that operators might use themselves."""
    from pyspark.sql import functions as F

    d = docs_of([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (None, "x y z"), (None, None), (4, " \n\t "), (5, "long words " * 30_000)])
    return d.withColumns({n: F.lit(7) for n in ("_row", "row", "id", "k", "fp", "score", "leaks", "_slice", "_u", "mix_size", "h", "label", "n_tokens", "digest", "_source", "_in0", "kept")})
