import hashlib

import pytest

from docgroups.operators import wordvec
from docgroups.registry import sources as registered
from docgroups.sources import corpus, results


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ArticleId,Text,Category\n1,"two\nlines, ""quoted""",tech\n2,plain,art\n3,,tech\n')
    rows = corpus.read_labelled_csv(spark, str(tmp_path)).collect()
    assert {(r["text"], r["label"], r["label_name"]) for r in rows} == {
        ('two\nlines, "quoted"', 1, "tech"), ("plain", 0, "art"), ("", 1, "tech"),
    }
    assert len({r["doc_id"] for r in rows}) == 3


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        corpus.read_labelled_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="Category"):
        corpus.read_labelled_csv(spark, str(tmp_path))


def test_posts(spark, tmp_path):
    for group, name, text in [("sci", "1", "From: a\n\nbody"), ("rec", "1", "From: b\n\n> q\nplay")]:
        (tmp_path / group).mkdir(exist_ok=True)
        (tmp_path / group / name).write_text(text)
    rows = corpus.read_posts(spark, str(tmp_path)).collect()
    assert {(r["label"], r["label_name"], r["text"]) for r in rows} == {(1, "sci", "body"), (0, "rec", "play")}
    assert sorted(r["file"].split("/")[-2:] for r in rows) == [["rec", "1"], ["sci", "1"]]


def test_posts_in_folders_below_their_group(spark, tmp_path):
    folder = tmp_path / "lang=en" / "doc_id=7"
    folder.mkdir(parents=True)
    (folder / "part-0").write_text("a=b")
    rows = corpus.read_posts(spark, str(tmp_path), clean=False, depth=2).collect()
    assert [(r["label_name"], r["text"]) for r in rows] == [("en", "a=b")]


def test_posts_query_writes_a_file_a_post(spark, tmp_path, monkeypatch):
    rows = [(1, "one\n\ntwo", "en"), (2, None, "en"), (3, "ends", "de"), (4, "twice", "de"), (4, "other", "en"), (5, "x", "fr"), (6, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(registered, "scratch_path", lambda spark, name: str(tmp_path / name))
    found = registered.posts(spark, str(tmp_path)).select("doc_id", "text_hash").collect()
    assert sorted((r["doc_id"] or 0, r["text_hash"]) for r in found) == sorted(
        (i or 0, hashlib.md5((text or "").encode()).hexdigest()) for i, text, _ in rows
    )
    # Folders follow the languages, not the posts: listing and moving a folder for each post took most of the time.
    folders = [p for p in (tmp_path / "posts").rglob("*") if p.is_dir()]
    assert len(folders) == 4 and len(list((tmp_path / "posts").rglob("*.txt"))) == len(rows)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_results_round_trip(spark, tmp_path, kind):
    rows = [("d", "tfidf", "kmeans", None, None, 3, 0.5, 0.25, 0.1, None, 0.0)]
    results.write_table(spark.createDataFrame(rows, results.RESULTS), str(tmp_path / "r"), kind)
    assert [tuple(r) for r in results.read_results(spark, str(tmp_path / "r"), kind=kind).collect()] == rows


def test_known_token_means(spark):
    docs = spark.createDataFrame([(1, "a a b zz"), (2, "zz"), (3, None)], "doc_id long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "token string, vec array<double>")
    means = wordvec.mean_vectors(docs, wordvec.token_counts(docs), vectors)
    got = {r["id"]: r["vec"] for r in means.collect()}
    assert got[1] == pytest.approx([2 / 3, 1.0]) and got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]


def test_word_vectors(spark):
    docs = spark.createDataFrame([(i, "red green blue green red blue") for i in range(6)] + [(9, "greenish")], "doc_id long, text string")
    vectors, words = wordvec.build_word2vec(docs, vector_size=8, epochs=1)
    assert {r["token"] for r in words.collect()} == {"red", "green", "blue"}
    assert [r["vec"] for r in vectors.where("id = 9").collect()] == [[0.0] * 8]
    subwords, _ = wordvec.build_fasttext(docs, vector_size=8, epochs=1)
    unseen = subwords.where("id = 9").first()["vec"]
    assert len(unseen) == 8 and any(unseen)


def test_parts_of_token_counts_follow_the_text(spark, monkeypatch):
    monkeypatch.setattr(wordvec, "PART_BYTES", 100)
    docs = spark.createDataFrame([(i, "ab " * 20) for i in range(200)] + [(0, "ab")], "doc_id long, text string")
    counts = wordvec.token_counts(docs)
    # 12,002 bytes; one part before, whatever the text, as Spark joined parts up to its own size.
    assert counts.rdd.getNumPartitions() == 121
    assert {r["doc_id"]: r["tf"] for r in counts.collect()} == {0: 21, **{i: 20 for i in range(1, 200)}}


def test_posts_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver listed every post and kept what it found; names, texts and paths stay those of Spark's reader."""
    names = ["lang=en/a.txt", "lang=en/b c%41.txt", "lang=é ü/[x]{y}^`|#?\"<>.txt", "lang=x%20/deep/er/n~!$&'()*+,;@=.txt", "top.txt", "_lang=1/p.txt",
             "lang=en/_hidden", "lang=en/.hidden", "_lang/p.txt", ".lang/p.txt", "lang=en/empty.txt", "lang=en/p._COPYING_"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else f"From: {name}\n\nA line\nand \xe9 more".encode("latin-1", "replace"))
    monkeypatch.setattr(corpus, "POSTS_A_TASK", 3)
    monkeypatch.setattr(corpus, "LISTED_AT_ONCE", 2)
    whole = corpus.read_posts
    with monkeypatch.context() as m:
        m.setattr(corpus, "_stored_posts", lambda spark, path: None)
        old = sorted(map(tuple, whole(spark, str(tmp_path), clean=False).collect()))
    read = type(spark.read)
    monkeypatch.setattr(read, "text", lambda *a, **k: pytest.fail("the driver lists the posts"))
    assert sorted(map(tuple, whole(spark, str(tmp_path), clean=False).collect())) == old
    assert len(old) == 6
