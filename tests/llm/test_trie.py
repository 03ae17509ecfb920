import hashlib
from collections import defaultdict

import duckdb
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from siltbed.llm import queries, trie

SF = "/root/testdata/sf0.001"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_trie_is_a_dictionary(keys):
    tree, want = trie.PatriciaTrie(), defaultdict(int)
    for k in keys:
        tree.insert(k, 1, lambda a, b: a + b)
        want[k] += 1
    assert dict(tree.items()) == want
    assert tree.held == tree._size(tree.root)
    assert dict(tree.spill()) == want and not list(tree.items()) and tree.held == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=6)), st.integers(0, 40))
def test_spill_by_subtree(keys, keep):
    """Subtrees leave whole, until what is held is little enough; nothing is lost or given twice."""
    tree, want = trie.PatriciaTrie(), defaultdict(int)
    for k in keys:
        tree.insert(k, 1, lambda a, b: a + b)
        want[k] += 1
    gone = list(tree.spill(keep))
    assert tree.held <= keep and tree.held == tree._size(tree.root)
    rest = list(tree.items())
    assert len(gone) + len(rest) == len(want) and dict(gone) | dict(rest) == want
    if len({k[:1] for k in keys}) > 1:
        # The root's subtrees are not taken apart.
        assert not {k[:1] for k, _ in gone if k} & {k[:1] for k, _ in rest if k}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=5)))
def test_finished_subtrees_leave_once(keys):
    tree, want, got = trie.PatriciaTrie(), defaultdict(int), []
    for k in sorted(keys):
        got += tree.finished(k)
        tree.insert(k, 1, lambda a, b: a + b)
        want[k] += 1
    got += tree.items()
    assert len(got) == len(want) and dict(got) == want


def brute(rows, keep=max):
    groups = defaultdict(list)
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for r in rows:
        groups[fold(r.text)].append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[fold(r.text)]
        best = keep([i for i in ids if i is not None], default=None)
        out.append((r.doc_id, best, len(ids), r.doc_id == best, hashlib.sha256(fold(r.text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(edge_docs, no_docs):
    rows = edge_docs.collect()
    for keep, by in (("largest", max), ("smallest", min)):
        got = trie.exact_duplicates(edge_docs, keep=keep).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, by)
    kept = trie.kept_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({x[1] for x in brute(rows)}, key=repr)
    assert trie.exact_duplicates(no_docs).count() == 0 and trie.kept_documents(no_docs).count() == 0


def test_small_memory_changes_nothing(edge_docs):
    got = trie.owners(edge_docs, limit=300).collect()
    assert sorted((r.keep_id, r.group_size) for r in got if r.keep_id) == sorted({x[1:3] for x in brute(edge_docs.collect()) if x[1]})


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op5_trie"]).fetchall()
    got = queries.op5_trie(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_tries_hold_many_documents():
    """Real documents of one partition share edges; a small limit spills subtrees and keeps others."""
    texts = [(t or "").lower().encode() for t in pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()]
    tree = trie.PatriciaTrie()
    for text in texts:
        tree.insert(text, 1, lambda a, b: a + b)
    different = set(texts)
    nodes, stack = [], [tree.root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += node.children.values()
    shared = [n for n in nodes if len(n.children) > 1 and n.edge]
    assert len(different) > 100 and len(shared) > 20
    assert tree.held < sum(map(len, different))
    before, gone = len(dict(tree.items())), dict(tree.spill(tree.held // 2))
    assert 0 < len(gone) < before == len(different) and len(gone) + len(dict(tree.items())) == before


def test_spilled_subtrees_meet_again(spark):
    """A limit far below a task's texts changes nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    with_limit = trie.owners(docs, limit=20_000)
    assert sorted(map(tuple, with_limit.collect())) == sorted(map(tuple, trie.owners(docs).collect()))
