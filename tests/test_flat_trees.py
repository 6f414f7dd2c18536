"""Trees as arrays against trees of nodes."""

import tracemalloc

from genoflux.operators import tree


def walked(root):
    """Places by recursion over nodes."""
    rows, place = [], [0]

    def walk(node, x):
        here = x + (node.length or 0.0)
        ys = [walk(c, here) for c in node.children]
        y = (min(ys) + max(ys)) / 2 if ys else float(place[0])
        place[0] += not ys
        rows.append({"name": node.name, "x": here, "y": y, "is_tip": not ys, "support": node.support if (node.support or 0) >= 10 else None})
        return y

    walk(root, -(root.length or 0.0))
    return rows


def test_arrays_lay_out_what_nodes_do(spark):
    texts = ["((A:0.1,B_n2:0.2)90:0.05,('C ''c':0.3,,D:0.4)5:0.1[note],(x)name)60:7;", "A;", "(a,(b,(c,d)11));"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "region int, text string")
    laid, nodes = tree.layout_rows(df, "region", min_support=10.0).collect(), tree.node_rows(df, "region").collect()
    for k, text in enumerate(texts):
        root = tree.parse(text)
        assert tree.layout(root, 10.0) == walked(root)
        key = lambda r: repr(sorted(r.items()))
        assert sorted(({c: r[c] for c in ("name", "x", "y", "is_tip", "support")} for r in laid if r["region"] == k), key=key) == sorted(walked(root), key=key)
        assert sum(r["region"] == k for r in nodes) == len(walked(root))
    assert {r["region"] for r in nodes} == {0, 1, 2}


def test_deep_and_long_trees_need_little(spark):
    """A tree of 3,000 levels, and under 300 bytes a node in one of 40,000 tips."""
    deep = "(" * 3000 + "a" + ":1)" * 3000 + ";"
    assert max(r["x"] for r in tree.layout(tree.parse(deep))) == 3000.0
    text = "(" + ",".join(f"'c {k}':0.25" for k in range(40_000)) + ");"
    tracemalloc.start()
    n = sum(1 for _ in tree._places(tree.flat(text), 10.0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40_001 and peak < 300 * n
