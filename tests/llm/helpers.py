"""Plain reference computations."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def components(nodes, links):
    """Least member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def odd_documents(spark, names=False):
    """Nulls in any column, empty and long texts, repeated rows, and columns whose names operators use inside."""
    long = " ".join(f"word{i % 997} of the {i % 13}th, line." for i in range(20_000))
    rows = [(1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, long, "en"), (4, long, "en"), (5, "a", "xx"), (None, "b c d e", "en"), (6, "a", "xx"), (None, None, None)]
    rows = [(*r, "s", None, 7, "t", "u", 1, "v") for r in rows]
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, block int, row string, key string, length long, fp string")
    if names:  # of extra columns that are no plain words
        out = out.selectExpr("*", "1 as `sp ace`", "named_struct('p.q', 'x', 'r s', 2) as `x.y`", "3 as `a-b`", "array('4') as `back``tick`", "5 as count")
    return out
