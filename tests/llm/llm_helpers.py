"""Constants and helpers of these tests."""

SF = "/root/testdata/sf0.001"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


#: Names that operators use inside; as extra columns they must not matter.
CLASHING = ("d k n lo hi a b at band bucket ord comp component family own blk spans extra kept words found "
            "term pos y f score lang_pred regs set gram rep lead tail ids").split()
EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "..."), (None, "one two three"),
             (None, None), (7, "é" * 300), (8, "word " * 30000), (9, "x" * 20000), (10, "a1 🙂 ß Σ\x00")]
