"""Mixing, line dedup, WARC and the pipeline; every query's SQL against DuckDB."""

import base64
import glob
import gzip
import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import queries, warc
from quarry.llm.line_dedup import line_dedup
from quarry.llm.mixing import mix, mixed_rows
from quarry.llm.warc import archive_table, page_number, read_warc, records_in, write_warc
from quarry.session import shared_dir


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    res = con.execute(queries.ORACLE[name])
    names = [d[0] for d in res.description]
    order = [names.index(c) for c in got.columns]
    def key(t):
        return tuple((x is not None, str(x)) for x in t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=key)


# ------------------------------------------------------------------- mixing

def water(sizes, weights, budget):
    """Targets by repeated resharing."""
    target, open_ = {}, dict(weights)
    left = budget
    while open_:
        unit = left / sum(open_.values())
        full = [s for s in open_ if unit * open_[s] > 2 * sizes[s]]
        if not full:
            return target | {s: unit * w for s, w in open_.items()}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_mix_against_resharing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    size = {r.doc_id: len((r.text or "").split()) for r in rows}
    sources = sorted({r.source for r in rows})
    total = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in sources}
    want = water(total, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}, 1.5 * sum(total.values()))
    got = {r.doc_id: r for r in mix(docs).collect()}
    taken = dict.fromkeys(sources, 0)
    for r in rows:
        g = got[r.doc_id]
        assert g.source_size == total[r.source] and abs(g.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and 0 <= g.copies <= 2
        taken[r.source] += g.size * g.copies
    largest = max(size.values())
    assert sum(taken.values()) <= 1.5 * sum(total.values())
    assert all(abs(taken[s] - want[s]) <= largest for s in sources)
    again = {r.doc_id: r.copies for r in mix(docs.repartition(5)).collect()}
    assert again == {k: g.copies for k, g in got.items()}


def test_mix_on_hostile_rows(hostile, empty):
    got = mix(hostile).collect()
    assert len(got) == hostile.count() and all(r.copies == 0 for r in got if r.size == 0)
    rows = mixed_rows(hostile)
    assert rows.columns == hostile.columns and rows.count() == sum(r.copies for r in got)
    assert mix(empty).count() == 0 and mixed_rows(empty).count() == 0
    blank = mix(hostile.where("length(coalesce(text, '')) = 0")).collect()
    assert blank and all(r.copies == 0 and r.target == 0 for r in blank)


def test_mix_where_one_identifier_fills_a_source(spark):
    """A third of all rows share an identifier; the sums stay exact and the source keeps its target."""
    words = "w " * 7
    df = spark.range(6000).selectExpr("IF(id < 2000, 1, id) AS doc_id", f"'{words}' AS text",
                                      "IF(id < 3000, 'a', IF(id < 4500, 'b', 'c')) AS source")
    got = mix(df).collect()
    assert len(got) == 6000
    taken = {}
    for r in got:
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.size * r.copies
    assert sum(taken.values()) <= 1.5 * 6000 * 7
    assert all(abs(t - target) <= 7 for (_, target), t in taken.items())


def test_mix_takes_the_same_rows_however_they_are_written(spark, tmp_path, monkeypatch):
    rows = [(i % 5 if i % 3 else None, f"src{i % 2}", " ".join(["w"] * (i % 9)), i % 4, {"m": i % 2}, i % 6) for i in range(400)]
    rows += [(7, "src0", "often the same identifier", i % 50, {"m": 1}, 0) for i in range(300)]
    rows += [(None, "src1", "equal in every column", 1, {"m": 1}, 0)] * 300
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int, copy map<string,int>, `a.b` int")
    seen, cells = set(), []
    for crowded in (8, 0.2, 1000):  # nowhere, nearly everywhere and never cut
        monkeypatch.setattr("quarry.llm.mixing.CROWDED", crowded)
        for parts in (1, 5):
            got = mixed_rows(df.repartition(parts, F.rand()))
            assert got.columns == df.columns
            seen.add(tuple(sorted(str(r.asDict()) for r in got.collect())))
    assert len(seen) == 1 and len(next(iter(seen))) > 1000
    df.repartition(3).write.parquet(str(tmp_path / "again"))
    assert tuple(sorted(str(r.asDict()) for r in mixed_rows(spark.read.parquet(str(tmp_path / "again"))).collect())) in seen


def test_names_that_clash_or_hold_dots(spark):
    from quarry.llm.exact_dedup import exact_dedup
    from quarry.llm.pieces import encoded
    from quarry.llm.secret_scan import scanned
    from quarry.llm.simhash import near_dedup
    names = ["doc_id", "text", "source", "a.b", "__common", "__copies", "__copy", "copies", "copy", "content", "cut", "piece", "weird`name"]
    df = spark.createDataFrame([(i, f"some words here {i // 2}", "s", *[i % 2] * 10) for i in range(12)], names)
    assert exact_dedup(df).columns == near_dedup(df).columns == mixed_rows(df).columns == names
    assert exact_dedup(df).count() == 6 and mixed_rows(df).count() == 18
    dotted = df.select(F.col("doc_id").alias("the.id"), F.col("text").alias("the.text"), F.col("source").alias("the.source"), "`a.b`")
    assert exact_dedup(dotted, "the.text", "the.id").count() == 6
    assert mixed_rows(dotted, "the.text", "the.id", "the.source").columns == dotted.columns
    assert scanned(dotted, "the.text", keep=["the.id", "a.b"]).columns[:2] == ["the.id", "a.b"]
    assert encoded(dotted, queries.piece_model(), "the.text", keep=["the.id", "a.b"]).columns[:2] == ["the.id", "a.b"]


# --------------------------------------------------------------- line dedup

def test_line_dedup_drops_site_boilerplate_only(spark):
    menu = "<nav><li>Home</li><li>About us</li></nav>"
    rows = [(i, f"https://u:p@Site.example:80/{i}", f"<html><script>Home\n</script><style>x</style><!-- Home --><body>{menu}<p>only {i}</p><p> shared by two{i // 2} </p></body>") for i in range(10)]
    rows += [(10, "http://other.example/", f"{menu}<p>alone</p>"), (11, None, f"{menu}<p>alone</p>"), (12, "not a url", menu), (13, "https://site.example/x", None), (13, "https://site.example/x", None)]
    df = spark.createDataFrame([(*r, "host", 5) for r in rows], "page_id long, url string, html string, host string, n_lines int")
    got = line_dedup(df, ratio=0.5)
    assert got.columns == [*df.columns, "host_", "n_lines_", "kept_lines"] and got.count() == len(rows)
    kept = {r.page_id: r.kept_lines for r in got.collect()}
    for i in range(10):
        assert kept[i] == [f"only {i}", f"shared by two{i // 2}"]
    assert kept[10] == kept[11] == ["Home", "About us", "alone"] and kept[12] == ["Home", "About us"] and kept[13] == []
    assert line_dedup(df.limit(0)).count() == 0


# --------------------------------------------------------------------- warc

def _plain(path, *members):
    """An archive at ``path`` of these (header lines, block) and its row for the reader."""
    with open(path, "wb") as f:
        for head, block in members:
            f.write(gzip.compress("\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"))


def _listed(spark, path):
    return archive_table(spark, str(path))


def _sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_verified_reads_all_or_fails(spark, tmp_path):
    from quarry.llm.warc import DamagedArchiveError, verified
    manifest = write_warc(pages(spark).coalesce(1), f"file:{tmp_path}/w")
    assert sorted(map(str, verified(read_warc(manifest), manifest).collect())) == sorted(map(str, read_warc(manifest).collect()))
    none = write_warc(pages(spark).limit(0))
    assert verified(read_warc(none), none).count() == 0
    path = manifest.first()["path"].removeprefix("file:")
    whole = open(path, "rb").read()
    starts = sorted(r.offset for r in read_warc(manifest).collect())
    for at in (starts[0] + 40, starts[4] + 200, starts[-1] + 60, starts[2] + 1):  # a bit of a body, a header, the magic
        broken = bytearray(whole)
        broken[at] ^= 0x10
        open(path, "wb").write(broken)
        with pytest.raises(DamagedArchiveError):
            verified(read_warc(manifest, split_bytes=500), manifest)
    open(path, "wb").write(whole[:starts[-1]])  # a whole record less, and its file is as long as the records in it
    shorter = manifest.withColumn("bytes", F.lit(starts[-1]).cast("long"))
    with pytest.raises(DamagedArchiveError, match="records"):
        verified(read_warc(shorter), shorter)
    os.remove(path)
    with pytest.raises(Exception, match="[Nn]o such file|not exist|open"):
        verified(read_warc(manifest), manifest)


def test_lengths_and_digests_are_of_the_bytes_read(spark, tmp_path):
    from quarry.llm.warc import DamagedArchiveError, verified
    kind = "Content-Type: application/http"
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    say = lambda digest, name="<a>": ["WARC-Type: response", f"WARC-Record-ID: {name}", f"WARC-Payload-Digest: sha1:{digest}", kind]
    again = lambda digest, to: (["WARC-Type: revisit", "WARC-Record-ID: <r>", f"WARC-Refers-To: {to}", f"WARC-Payload-Digest: sha1:{digest}", kind], body[:-3])
    _plain(tmp_path / "right.gz", (say(_sha(b"abc")), body), again(_sha(b"abc"), "<a>"))
    got = verified(read_warc(_listed(spark, tmp_path / "right.gz")), _listed(spark, tmp_path / "right.gz")).collect()
    assert [(r.payload_digest, r.payload_bytes) for r in got] == [(_sha(b"abc"), 3)] * 2
    _plain(tmp_path / "digest.gz", (say("AAAA"), body))
    wrong = _listed(spark, tmp_path / "digest.gz")
    assert read_warc(wrong).first()["payload_digest"] == _sha(b"abc")
    with pytest.raises(DamagedArchiveError):
        verified(read_warc(wrong), wrong)
    _plain(tmp_path / "length.gz", (say(_sha(b"ab")), body[:-1]))
    with pytest.raises(DamagedArchiveError):
        verified(read_warc(_listed(spark, tmp_path / "length.gz")), _listed(spark, tmp_path / "length.gz"))
    for name, digest, to in (("lost.gz", _sha(b"abc"), "<b>"), ("other.gz", _sha(b"abd"), "<a>")):
        _plain(tmp_path / name, (say(_sha(b"abc")), body), again(digest, to))
        with pytest.raises(Exception, match="no response with the payload"):
            verified(read_warc(_listed(spark, tmp_path / name)), _listed(spark, tmp_path / name)).collect()


def test_stores_that_no_task_could_open_are_refused_first(spark):
    from quarry.llm.warc import _open
    with pytest.raises(ValueError, match="wasbs"):
        write_warc(pages(spark), "wasbs://c@account/archives")
    assert _open("file:/a/b")[1] == _open("file:///a/b")[1] == _open("/a/b")[1] == "/a/b" and _open("dbfs:/a/b")[1] == "/dbfs/a/b"


PAGES = [(1, "http://a/", "x"), (2, "http://b/", "x"), (3, "http://c/\r\nEvil: 1", ""), (4, None, None), (5, "http://é/", "é😀" * 50_000), (6, "http://d/", "unique"),
         (None, "http://n/", "x"), (None, None, "only null ids"), (7, "http://g/", "line\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (6, "http://d/", "unique")]


def pages(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("split", [37, 1000, 1 << 20])
def test_round_trip_for_any_split(spark, split):
    manifest = write_warc(pages(spark).repartition(3))
    got = read_warc(manifest, split_bytes=split).collect()
    assert len(got) == len(PAGES) and len({(r.path, r.offset) for r in got}) == len(PAGES)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for key, _, html in PAGES:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    want = sorted((str(k), sha(h), len((h or "").encode()), "response" if k == first.get(h or "") else "revisit", first[h or ""] if k != first.get(h or "") else None)
                  for k, _, h in PAGES if (h or "") in first)
    want += [("None", sha("only null ids"), 13, "response", None)]
    rows = [(r.record_id[len("<urn:x-page:"):-1] or "None", r.payload_digest, r.payload_bytes, r.record_type, int(r.refers_to[12:-1]) if r.refers_to else None) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)
    for r in got:
        assert r.digest_ok is (True if r.record_type == "response" else None)
        assert (r.payload is None) == (r.record_type == "revisit")
    assert {r.target_uri for r in got if "Evil" in (r.target_uri or "")} == {"http://c/%0D%0AEvil: 1"}


def test_reader_passes_over_false_magic_and_damage(tmp_path):
    record = lambda body: b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    inner = gzip.compress(record(b"inside another record"))
    good = [gzip.compress(record(b"first")), gzip.compress(record(inner), compresslevel=0), gzip.compress(record(b"last"))]
    cut = gzip.compress(record(b"damaged" * 100))[:-9]
    data = b"\x1f\x8b\x08 no member \x1f\x8b" + good[0] + gzip.compress(b"no record") + cut + good[1] + good[2]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    for split in (11, 64, 10_000):
        found = [b for s in range(0, len(data), split) for _, _, b in records_in(str(path), len(data), s, s + split)]
        assert [b for b in found if b in (b"first", b"last")] == [b"first", b"last"] and inner in found


def test_reader_takes_headers_of_any_length(tmp_path):
    url = "data:," + random.Random(7).randbytes(3 << 20).hex()
    member = warc._record(1, url, b"one", "D", None, "2024-01-01T00:00:00Z") + warc._record(2, "u", b"two", "D", None, "2024-01-01T00:00:00Z")
    (tmp_path / "long.warc.gz").write_bytes(member)
    got = [warc._row("p", *r) for r in warc.records_in(f"{tmp_path}/long.warc.gz", len(member), 0, len(member))]
    assert [r[8] for r in got] == [b"one", b"two"] and got[0][4] == url


def test_blocks_that_are_not_http_are_whole_payloads(tmp_path):
    blocks = [("warcinfo", "application/warc-fields", b"software: x\r\nformat: WARC\r\n"), ("conversion", "text/plain", b"no blank line"),
              ("resource", "text/plain", b"Content-Length: 3\r\n\r\nrest of the text"), ("metadata", None, b"a: b\r\n\r\n"),
              ("response", "Application/HTTP;msgtype=response", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi")]
    out = b""
    for kind, content, block in blocks:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n" + (f"Content-Type: {content}\r\n" if content else "") + f"Content-Length: {len(block)}\r\n\r\n"
        out += gzip.compress(head.encode() + block + b"\r\n\r\n")
    (tmp_path / "other.warc.gz").write_bytes(out)
    got = [warc._row("p", *r) for r in records_in(f"{tmp_path}/other.warc.gz", len(out), 0, len(out))]
    want = [b for _, _, b in blocks[:4]] + [b"hi"]
    assert [r[8] for r in got] == want and [r[7] for r in got] == [len(b) for b in want]


def test_small_payloads_stay_responses_and_archives_roll(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    write_warc(pages(spark).coalesce(1), folder, least_payload=2, archive_bytes=400)
    listed = archive_table(spark, folder)
    assert listed.count() > 3  # 400 bytes hold few records
    got = read_warc(listed, payloads=False)
    types = {(r.page, r.payload_bytes): r.record_type for r in got.withColumn("page", page_number(got.record_id)).collect()}
    assert types[1, 1] == types[2, 1] == "response" and got.where("payload is not null").count() == 0
    assert write_warc(pages(spark).limit(0)).count() == 0 and read_warc(write_warc(pages(spark).limit(0))).count() == 0


# ----------------------------------------------------------------- pipeline

def test_pipeline_stages_one_by_one(spark, sf):
    """Each stage on all that the stage before kept; its effect against brute force."""
    import brute

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept, before = [], docs
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        kept.append(after.collect())
        before = spark.createDataFrame(kept[-1], after.schema) if kept[-1] else after
    assert all(k and list(k[0].asDict()) == columns for k in kept[:4])
    quality, exact, near, mixed, pieces = ([r.doc_id for r in k] for k in kept)
    rejected = {r.doc_id for r in docs.select("doc_id").collect()} - set(quality)
    assert rejected and sum(labels.get(d, 0) == 0 for d in rejected) >= 0.9 * len(rejected)
    texts = {}
    for r in kept[0]:
        texts.setdefault(brute.squeezed(r.text), []).append((-len(r.text), r.doc_id))
    assert sorted(exact) == sorted(min(g)[1] for g in texts.values())
    rows = sorted((r.doc_id, brute.simhash(r.text)) for r in kept[1])
    roots = brute.groups_within([p for _, p in rows], 2)
    assert sorted(near) == sorted({rows[i][0] for i in roots})
    sizes = {r.doc_id: len(brute.WORD.findall(r.text)) for r in kept[2]}
    assert set(mixed) <= set(near) and max(mixed.count(d) for d in set(mixed)) <= 2
    assert abs(sum(sizes[d] for d in mixed) - 1.5 * sum(sizes.values())) <= max(sizes.values())
    texts = {r.doc_id: r.text for r in kept[3]}
    assert sorted(pieces) == sorted(mixed) and all(
        r.n_corrected == 0 and r.decoded == texts[r.doc_id] for r in kept[4])


def test_run_returns_the_last_stage(spark, sf):
    at = shared_dir(spark).replace("file:", "") + "/quarry-stage/*"
    before = set(glob.glob(at))
    got = corpus_pipeline.run(spark, sf)
    assert len(set(glob.glob(at)) - before) == 1  # the result; what the stages staged is gone
    assert {"doc_id", "ids", "n_tokens", "decoded"} <= set(got.columns) and got.count() > 0


def test_every_stage_on_hostile_rows_and_empty_tables(spark, sf, hostile, empty):
    for docs in (hostile, hostile.withColumnsRenamed({"keep_id": "ids", "size": "score", "n_chars": "__text"}), empty):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, sf)
            rows = got.collect()
            assert bool(rows) == (docs is not empty), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert got.columns == docs.columns
            else:
                assert len(set(got.columns)) == len(got.columns) and len(rows) == docs.count()
