import json

import pytest

from threadlens.sources.annotations import read_annotations
from threadlens.sources.messages import ingest_messages, load_messages
from threadlens.sources.scratch import shared_folder

CSV = '''tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id
 1 ,a,True,2017-10-31 22:10:47,"line one
line ""two"", end",2,
2,b,false,bad date,plain,,1
3,c, TRUE ,,,nan,nan
4,d,,,x,,
'''


def test_csv_messages(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(CSV)
    rows = load_messages(spark, str(path)).orderBy("ingest_seq").collect()
    assert [r.tweet_id for r in rows] == ["1", "2", "3", "4"]
    assert [r.inbound for r in rows] == [True, False, True, False]
    assert rows[0].text == 'line one\nline "two", end' and str(rows[0].created_at) == "2017-10-31 22:10:47"
    assert rows[1].created_at is None and rows[2].text is None
    assert rows[2].in_response_to_tweet_id is None and rows[1].in_response_to_tweet_id == "1"
    table = ingest_messages(spark, str(path), shared_folder(spark, "messages"))
    assert [r.tweet_id for r in table.orderBy("ingest_seq").collect()] == ["1", "2", "3", "4"]


def test_order_of_many_files(spark, tmp_path):
    """Three hundred files, several rows each: files by path, rows as they stand."""
    want = []
    for k in range(300):
        rows = [f"{k}-{j}" for j in range(k % 4 + 1)]
        (tmp_path / f"part-{k:05d}.csv").write_text("tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n"
                                                    + "".join(f'{r},a,True,,"x\ny",,\n' for r in rows))
        want += rows
    loaded = load_messages(spark, str(tmp_path))
    rows = loaded.orderBy("ingest_seq").collect()
    assert [r.tweet_id for r in rows] == want and len({r.ingest_seq for r in rows}) == len(want)


def test_annotation_files(spark, tmp_path):
    js = tmp_path / "a.json"
    js.write_text(json.dumps([{"id": 1, "text": "x", "gold_intent": ""}, {"id": 2, "text": "y", "gold_intent": "other"}]))
    rows = read_annotations(spark, str(js), ["id", "text", "gold_intent"]).orderBy("row_no").collect()
    assert [(r.row_no, r.id, r.gold_intent) for r in rows] == [(1, "1", ""), (2, "2", "other")]
    cs = tmp_path / "a.csv"
    cs.write_text('id,text,gold_intent\n1,"a, b",\n2,NA,""\n')
    rows = read_annotations(spark, str(cs), ["id", "text", "gold_intent"]).orderBy("row_no").collect()
    assert [(r.id, r.text, r.gold_intent) for r in rows] == [("1", "a, b", ""), ("2", "NA", "")]
    with pytest.raises(ValueError):
        read_annotations(spark, "a.txt")


def test_columns_by_name_and_file_order(spark, tmp_path):
    head = "author_id,extra,tweet_id,text,inbound,created_at,in_response_to_tweet_id,response_tweet_id\n"
    folder = tmp_path / "m"
    folder.mkdir()
    (folder / "part-0.csv").write_text(head + "a,z,1,x,True,Tue Oct 31 22:10:47 +0000 2017,,\n")
    (folder / "part-1.csv").write_text(head + "".join(f"b,z,{k},{'y' * 500},False,2017-10-31 22:10:47,1,\n" for k in range(2, 40)))
    rows = load_messages(spark, str(folder)).orderBy("ingest_seq").collect()
    assert [r.tweet_id for r in rows] == [str(k) for k in range(1, 40)]
    assert rows[0].author_id == "a" and str(rows[0].created_at) == "2017-10-31 22:10:47" == str(rows[1].created_at)
    (tmp_path / "short.csv").write_text("tweet_id,text\n1,x\n")
    with pytest.raises(ValueError, match="author_id"):
        load_messages(spark, str(tmp_path / "short.csv"))
    (tmp_path / "r.csv").write_text("text,more,id\nhello,1,7\n")
    assert [tuple(r) for r in read_annotations(spark, str(tmp_path / "r.csv"), ["id", "text"]).collect()] == [("7", "hello", 1)]
