"""Rows that every operator must bear, shared by the tests of this folder."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns with names that the operators use themselves
    T.StructField("ids", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    T.StructField("rid", T.LongType()), T.StructField("component", T.LongType()), T.StructField("words", T.StringType()),
])

PROSE = ("It was late in the year when the old ferry left the harbour for the last time, and only a few people had come "
         "to see it go. The captain raised his hand, the engine coughed twice, and the grey water closed behind them. ")
OTHER = ("Nobody in the village could remember who had planted the orchard above the road, yet every autumn the same "
         "families went up with ladders and baskets and shared what they found among the low branches. ")


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    def row(i, t, lang="en"):
        return (i, t, lang, "s", None if t is None else len(t), "x", 0.5, True, 7, 9, "w")

    long_text = (OTHER + PROSE) * 300
    return [
        row(1, PROSE * 2), row(2, PROSE * 2), row(2, PROSE * 2), row(3, PROSE * 2 + "One more word here."), row(4, None),
        row(5, ""), row(6, "   \n\t "), row(7, "two words"), row(8, "two words"), row(9, long_text), row(10, None, None),
        row(None, PROSE), row(None, None), row(11, "héllo wörld ▁ 中文 \U0001F600"), row(12, "!!! 123 $$$", None),
        row(13, OTHER), row(14, OTHER.replace("ladders", "ropes")), row(15, "a" * 5000), row(16, "A " * 3000),
    ]
