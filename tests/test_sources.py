"""Readers and writers against small files."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metapep.ranks import EC_NUMBERS, TAXONS
from metapep.sources import flatfile, lz4, ontologies, taxdump, tsv
from metapep.streaming import current_entries, read_entry_stream, upsert_entries

RECORD = """ID   XYL7_TESTA              Reviewed;         120 AA.
AC   Q7ZZ01; Q7ZZ02;
DT   03-MAR-1999, integrated into UniProtKB/Swiss-Prot.
DT   04-APR-2001, sequence version 2.
DT   05-MAY-2022, entry version 17.
DE   RecName: Full=Invented xylose carrier;
OS   Testudo inventa (made up).
OX   NCBI_TaxID=778899;
OH   NCBI_TaxID=1234; A host.
DR   EMBL; AB000001; -.
DR   Proteomes; UP000012345; Unplaced.
DR   GO; GO:0000111; P:sugar transport; IEA.
DR   GO; GO:0000222; F:carrier activity; IEA.
DR   InterPro; IPR000333; Carrier_1.
DR   InterPro; IPR000444; Carrier_2.
PE   2: Seen;
SQ   SEQUENCE   120 AA;  13000 MW;  0123456789ABCDEF CRC64;
     MKWVTFISLL FLFSSAYSRG VFRRDTHKSE IAHRFKDLGE EHFKGLVLIA FSQYLQQCPF
     DEHVKLVNEL TEFAKTCVAD ESHAGCEKSL HTLFGDELCK VASLRETYGD MADCCEKQEP"""


def test_records_and_fields(spark, tmp_path):
    second = RECORD.replace("Q7ZZ01", "Q2").replace("Swiss-Prot", "TrEMBL")
    (tmp_path / "a.dat").write_text(f"some log line\n{RECORD}\n//\n{second}\n//\n{RECORD}")  # the last one has no end
    (tmp_path / "b.dat").write_text(f"{RECORD}\n//")
    (tmp_path / "c.dat").write_bytes(f"{RECORD}\n//\n".replace("\n", "\r\n").encode())
    assert flatfile.read_records(spark, str(tmp_path / "a.dat")).count() == 2
    assert flatfile.read_records(spark, str(tmp_path / "b.dat")).count() == 1
    assert flatfile.read_records(spark, str(tmp_path / "[ab].dat")).count() == 3
    assert flatfile.parse_entries(flatfile.read_records(spark, str(tmp_path / "c.dat"))).first().accession == "Q7ZZ01"
    one, two = flatfile.parse_entries(flatfile.read_records(spark, str(tmp_path / "a.dat"))).orderBy(*flatfile.PLACE).collect()
    assert (one.accession, one.version, one.taxon_id, one.type, one.name) == ("Q7ZZ01", "17", 778899, "swissprot", "Invented xylose carrier")
    assert (one.ec, one.go, one.ipr, one.proteomes) == ([], ["GO:0000111", "GO:0000222"], ["IPR000333", "IPR000444"], ["UP000012345"])
    assert len(one.sequence) == 120 and one.sequence.startswith("MKWVTFISLLFLFSS") and one.sequence.endswith("KQEP")
    assert (two.accession, two.type) == ("Q2", "trembl")


def test_files_of_all_kinds_in_order(spark, tmp_path):
    """Unlike line ends, sizes, compression and tails; places are in file order however files are split."""
    import gzip

    def text(name, n, end="\n", tail=""):
        return (end.join(f"log line\n{RECORD}\n//".replace("Q7ZZ01", f"{name}{k}").replace("\n", end) for k in range(n)) + end + tail.replace("\n", end)).encode()

    (tmp_path / "a.dat").write_bytes(text("A", 3, "\r\n", f"junk\n{RECORD}"))
    (tmp_path / "b.dat").write_bytes(text("B", 50))
    (tmp_path / "c.dat").write_bytes(text("C", 5, "\r\n").rstrip())  # ends with the slashes
    (tmp_path / "d.dat").write_bytes(RECORD.encode())  # a tail alone
    (tmp_path / "e empty.dat").write_bytes(b"")
    (tmp_path / "f.dat.gz").write_bytes(gzip.compress(text("F", 4, tail=f"{RECORD}\n/")))
    (tmp_path / "g.dat").write_bytes(text("G", 2, tail="\n  \n//\n//\n"))
    want = [f"{c}{k}" for c, n in (("A", 3), ("B", 50), ("C", 5), ("F", 4), ("G", 2)) for k in range(n)]
    for split in ("2500", "9000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        for entries in (flatfile.read_entries(spark, str(tmp_path)), flatfile.parse_entries(flatfile.read_records(spark, str(tmp_path)))):
            rows = entries.orderBy(*flatfile.PLACE).collect()
            assert [r.accession for r in rows] == want and all(len(r.sequence) == 120 for r in rows)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "h.dat").write_bytes(f"{RECORD}\n//\nbroken\n//\n".encode())
    with pytest.raises(Exception, match="no AC line"):
        flatfile.read_entries(spark, str(tmp_path)).collect()


def test_files_are_read_once(spark, tmp_path):
    """Parsing reads the text in one job; tails are found in the parsed table."""
    (tmp_path / "a.dat").write_text(f"{RECORD}\n//\n{RECORD}")
    entries = flatfile.read_entries(spark, str(tmp_path))
    (tmp_path / "a.dat").unlink()
    assert entries.count() == 1


def described(spark, *lines: str):
    text = RECORD.replace("DE   RecName: Full=Invented xylose carrier;\n", "".join(f"DE   {x}\n" for x in lines))
    return flatfile.parse_entries(spark.createDataFrame([(text,)], "value string")).first()


def test_names_and_enzymes(spark):
    assert described(spark, "RecName: Full=P;", "Contains:", "  RecName: Full=C1;", "  RecName: Full=C2;").name == "C2"
    assert described(spark, "RecName: Full=P;", "Includes:", "  RecName: Full=D;").name == "D"
    assert described(spark, "RecName: Full=P;", "Includes:", "  RecName: Full=D;", "Contains:", "  RecName: Full=C;").name == "C"  # counts as a domain: the last one
    assert described(spark, "SubName: Full=S1;", "SubName: Full=S2 {ECO:1};").name == "S2"
    assert described(spark, "RecName: Full=P;", "Contains:", "  SubName: Full=S;").name == "P"
    assert described(spark, "AltName: Full=A;").name == ""
    assert described(spark, "RecName: Full=P;", "  EC=1.1.1.1 {ECO:1};", "Contains:", "  EC=1.1.1.1;", "  EC=2.1.1.-;").ec == ["1.1.1.1", "2.1.1.-"]


def test_without_references(spark):
    text = "\n".join(x for x in RECORD.split("\n") if not x.startswith("DR"))
    r = flatfile.parse_entries(spark.createDataFrame([(text,)], "value string")).first()
    assert r.go == [] and len(r.sequence) == 120


def test_malformed(spark):
    rows = [(RECORD,), ("x",), (RECORD.replace("UniProtKB/Swiss-Prot.", "Other."),), (RECORD.replace("778899", "abc"),), ("",)]
    df = spark.createDataFrame(rows, "value string")
    assert [r.error for r in flatfile.parse_entries(df, mode="PERMISSIVE").collect()] == [None, "no AC line", "unknown database", "no taxon", "no AC line"]
    with pytest.raises(Exception, match="malformed record"):
        flatfile.parse_entries(df).collect()


def test_compressed(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.dat.gz", "wt") as f:
        f.write(f"{RECORD}\n//\n{RECORD}\n//\n")
    assert flatfile.read_records(spark, str(tmp_path / "a.dat.gz")).count() == 2
    other = RECORD.replace("Q7ZZ01", "Q3")
    with gzip.open(tmp_path / "b open.dat.gz", "wt") as f:
        f.write(f"{RECORD}\n//\n{other}\n//\n{RECORD}\n")  # the last one has no end
    with gzip.open(tmp_path / "c.dat.gz", "wb") as f:
        f.write(f"{RECORD}\n//".encode())
    (tmp_path / "d open.dat").write_text(f"{other}\n//\n{RECORD}")
    entries = flatfile.parse_entries(flatfile.read_records(spark, str(tmp_path / "*.dat*")))
    assert sorted(r.accession for r in entries.collect()) == ["Q3"] * 2 + ["Q7ZZ01"] * 4
    with gzip.open(tmp_path / "e.dat.gz", "wb") as f:
        f.write(f"{RECORD}\n//\n{RECORD}".replace("\n", "\r\n").encode())
    assert flatfile.read_records(spark, str(tmp_path / "e.dat.gz")).count() == 1


def test_lz4_lines(spark, tmp_path):
    """Linked and independent blocks, stored ones, checksums, frames in a row; lines that cross blocks and runs."""
    import random

    def packed(data, size, flags=0x60, kind=4):
        codec, out = pa.Codec("lz4_raw"), lz4._head(flags, kind << 4)
        for a in range(0, len(data), size):
            raw = data[a : a + size]
            small = codec.compress(raw, asbytes=True)
            out += (len(small).to_bytes(4, "little") + small) if len(small) < len(raw) else ((len(raw) | lz4.STORED).to_bytes(4, "little") + raw)
        return out + bytes(4)

    def linked(data):
        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "lz4") as out:
            out.write(data)
        return sink.getvalue().to_pybytes()

    rnd = random.Random(4)
    lines = ["\n" * 9, *(f"{i}\tü{'x' * rnd.randrange(60)}\n" for i in range(3000)), "long " * 9000 + "\n", "\n", *(f"{rnd.getrandbits(400):x}\n" for _ in range(500)), "last"]
    data = "".join(lines).encode()
    want = sorted(data.decode().split("\n"))
    skipped = (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"other"
    files = {"linked": linked(data), "alone": packed(data, 1000), "sevens": packed(data, 7777), "mixed": packed(data[:9000], 500) + skipped + linked(data[9000:50_001]) + linked(b"") + packed(data[50_001:], 64 << 10)}
    for name, content in files.items():
        (tmp_path / f"{name} file.lz4").write_bytes(content)
        for run in (4000, 50_000, 16 << 20):
            assert sorted(r.value for r in lz4.read_lines(spark, str(tmp_path / f"{name} file.lz4"), run).collect()) == want, (name, run)
    ends = packed(b"a\nb\n", 2) + packed(b"\nc", 1)  # lines that end with a run
    (tmp_path / "ends.lz4").write_bytes(ends)
    assert sorted(r.value for r in lz4.read_lines(spark, str(tmp_path / "ends.lz4"), 1).collect()) == ["", "a", "b", "c"]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.lz4").write_bytes(b"")
    (tmp_path / "none" / "b.lz4").write_bytes(linked(b""))
    assert lz4.read_lines(spark, str(tmp_path / "none")).count() == 0
    for k, broken in enumerate((files["alone"][:-9], files["linked"][:-9], b"no frame at all")):
        (tmp_path / f"broken{k}").write_bytes(broken)
        with pytest.raises(Exception, match="ends within a frame|has no frame"):
            lz4.read_lines(spark, str(tmp_path / f"broken{k}")).count()


def test_lz4_tables(spark, tmp_path):
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("value"), F.sha2(F.col("id").cast("string"), 512).alias("noise"))
    tsv.write_tsv(rows.select("value", F.lit("ü\u2028").alias("t"), "noise").repartition(1), str(tmp_path / "t"), "lz4")
    back = tsv.read_tsv(spark, str(tmp_path / "t"), spark.createDataFrame([], "value long, t string, noise string").schema, compression="lz4")
    assert back.filter("t = 'ü\u2028' and noise = sha2(cast(value as string), 512)").agg(F.count("*"), F.sum("value")).first()[:] == (200_000, 199_999 * 100_000)
    assert lz4.read_lines(spark, str(tmp_path / "t"), 4 << 20).groupBy(F.spark_partition_id()).count().count() > 2  # of one file
    part = next((tmp_path / "t").glob("part-*.lz4"))
    with pa.CompressedInputStream(pa.OSFile(str(part)), "lz4") as stream:
        assert stream.read().count(b"\n") == 200_000
    assert sorted(p.name[:8] for p in (tmp_path / "t").iterdir()) == ["_SUCCESS", "part-000"]
    with pytest.raises(FileExistsError):
        tsv.write_tsv(rows, str(tmp_path / "t"), "lz4")
    tsv.write_tsv(rows.limit(0), str(tmp_path / "t"), "lz4", "overwrite")
    assert lz4.read_lines(spark, str(tmp_path / "t" / "*")).count() == 0

    @F.udf("string")
    def failing(i):
        return 1 / (i - 77) and "x"

    with pytest.raises(Exception, match="division by zero"):
        lz4.write_lines(spark.range(100).select(failing("id").alias("value")), str(tmp_path / "failed"))
    assert not any((tmp_path / "failed").glob("part-*")) and not (tmp_path / "failed" / "_SUCCESS").exists()


def test_ontologies(spark, tmp_path):
    lines = spark.createDataFrame([("1. 1. 1.-    With NAD(+) as acceptor.",), ("1. -. -.-  Oxidoreductases.",), ("Not one",)], "value string")
    assert [tuple(r) for r in ontologies.enzyme_classes(lines).collect()] == [("1.1.1.-", "With NAD(+) as acceptor"), ("1.-.-.-", "Oxidoreductases")]
    records = spark.createDataFrame([("ID   1.1.1.1\nDE   Alcohol dehydrogenase.\nAN   x",), ("ID   1.1.1.2\nDE   Long name,\nDE   continued.",), ("CC   header",)], "value string")
    assert [tuple(r) for r in ontologies.enzyme_entries(records).collect()] == [("1.1.1.1", "Alcohol dehydrogenase"), ("1.1.1.2", "Long namecontinued")]
    (tmp_path / "go.obo").write_text("format-version: 1.2\n\n[Term]\nid: GO:0000001\nname: n\nnamespace: biological_process\nalt_id: GO:0000009\n\n[Typedef]\nid: part_of\nname: p\n\n[Term]\nid: GO:0000002\nname: m\nnamespace: cellular_component\nis_obsolete: true\n")
    assert [tuple(r) for r in ontologies.read_go_terms(spark, str(tmp_path / "go.obo")).orderBy("id").collect()] == [(1, "GO:0000001", "biological process", "n"), (2, "GO:0000009", "biological process", "n"), (3, "GO:0000002", "cellular component", "m")]
    (tmp_path / "entry.list").write_text("ENTRY_AC\tENTRY_TYPE\tENTRY_NAME\nIPR000001\tDomain\tKringle\n")
    assert [tuple(r) for r in ontologies.read_interpro(spark, str(tmp_path / "entry.list")).collect()] == [(1, "IPR000001", "Domain", "Kringle")]
    (tmp_path / "r.xml").write_text('<a xmlns="urn:x"><version>2024_01</version><version>9</version></a>')
    assert ontologies.read_release(spark, str(tmp_path / "r.xml")).first().version == "2024.01"
    with pytest.raises(Exception, match="no version"):
        ontologies.release_version(spark.createDataFrame([("<a/>",)], "value string")).collect()
    (tmp_path / "p.tsv").write_text("id\torg\tn\nUP2\t9\t20\nUP1\t7\t10\n")
    assert [tuple(r) for r in ontologies.reference_proteomes(spark, str(tmp_path / "p.tsv")).orderBy("upid").collect()] == [("UP1", 7, 10), ("UP2", 9, 20)]
    (tmp_path / "classes.txt").write_text("1. -. -.-  Oxidoreductases.\n")
    (tmp_path / "enzyme.dat").write_text("CC   header\n//\nID   1.1.1.1\nDE   Alcohol dehydrogenase.\n//\n")
    assert [tuple(r) for r in ontologies.read_ec_numbers(spark, str(tmp_path / "classes.txt"), str(tmp_path / "enzyme.dat")).orderBy("id").collect()] == [(1, "1.-.-.-", "Oxidoreductases"), (2, "1.1.1.1", "Alcohol dehydrogenase")]


def test_tsv_round_trip(spark, tmp_path):
    taxa = spark.createDataFrame([(1, 'ro"ot', "no rank", 1, True), (2, "", "genus", None, False)], TAXONS)
    tsv.write_tsv(taxa, str(tmp_path / "taxons"), compression="gzip")
    assert sorted(map(tuple, tsv.read_tsv(spark, str(tmp_path / "taxons"), TAXONS).collect())) == [(1, 'ro"ot', "no rank", 1, True), (2, "", "genus", None, False)]
    tsv.write_tsv(spark.createDataFrame([(1, ["a", "b"])], "id int, l array<string>"), str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first().value == "1\ta;b"
    assert EC_NUMBERS.names == ["id", "code", "name"]


def test_dump_archive(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("nodes.dmp", "1\t|\t1\t|\tno rank\t|")
        z.writestr("names.dmp", "1\t|\troot\t|\t\t|\tscientific name\t|")
    assert len(taxdump.unzip_members(str(tmp_path / "d.zip"), str(tmp_path))) == 2


def test_nodes_need_names(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank")], "id int, parent_id int, rank string")
    with pytest.raises(Exception, match="no name for taxon"):
        taxdump.taxa(nodes, spark.createDataFrame([], "id int, name string")).collect()
    ranks = spark.createDataFrame([("subcohort",), ("acellular root",), ("cellular root",), ("genus",)], "r string")
    assert [r[0] for r in ranks.select(taxdump.rewritten_rank(F.col("r"))).collect()] == ["no rank", "domain", "no rank", "genus"]


def entry(accession: str, version: int, name: str = "P") -> str:
    return RECORD.replace("Q7ZZ01", accession).replace("version 17", f"version {version}").replace("Invented xylose carrier", name) + "\n//\n"


def run(spark, tmp_path, seen, **k):
    q = upsert_entries(read_entry_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), then=lambda rows, n: seen.append((n, sorted((r.accession, int(r.version)) for r in rows.collect()))), **k)
    q.awaitTermination(300)
    assert q.exception() is None


def state(spark, tmp_path):
    return sorted((r.accession, int(r.version), r.name) for r in current_entries(spark, str(tmp_path / "out")).collect())


def test_stream_passes_on_changes_only(spark, tmp_path):
    """New, changed, same, older and malformed entries over restarts; batches out of order; snapshots."""
    (tmp_path / "in").mkdir()
    seen: list = []
    (tmp_path / "in/a.dat").write_text(entry("A1", 5) + entry("A2", 7) + "broken\n//\n" + entry("A1", 6) + entry("A9", 1)[:-4])
    run(spark, tmp_path, seen, snapshot_every=2)
    (tmp_path / "in/b.dat").write_bytes((entry("A1", 6) + entry("A2", 6, "older") + entry("A3", 1)).replace("\n", "\r\n").encode())
    run(spark, tmp_path, seen, snapshot_every=2)
    (tmp_path / "in/c.dat").write_text(entry("A3", 1, "renamed") + entry("A2", 8))
    run(spark, tmp_path, seen, snapshot_every=2)
    run(spark, tmp_path, seen, snapshot_every=2)  # nothing new
    assert seen == [(0, [("A1", 6), ("A2", 7)]), (1, [("A3", 1)]), (2, [("A2", 8), ("A3", 1)])]
    assert state(spark, tmp_path) == [("A1", 6, "P"), ("A2", 8, "P"), ("A3", 1, "renamed")]
    bad = spark.read.parquet(str(tmp_path / "out/quarantine"))
    assert sorted((r.error, r.value.split("\n")[0]) for r in bad.collect()) == [("no AC line", "broken"), ("no end", RECORD.split("\n")[0])]
    assert [f.name for f in (tmp_path / "out/snapshots").iterdir()] == ["batch=1"]


def test_stream_batch_runs_again(spark, tmp_path):
    """A batch whose commit was lost, after its snapshot was made, gives the same changes and state."""
    (tmp_path / "in").mkdir()
    seen: list = []
    for k, text in enumerate([entry("A1", 1) + entry("A2", 1), entry("A1", 2), entry("A2", 3), entry("A1", 2, "same version")]):
        (tmp_path / f"in/{k}.dat").write_text(text)
        run(spark, tmp_path, seen, snapshot_every=1)
        before = state(spark, tmp_path)
        (tmp_path / f"state/commits/{k}").unlink()
        (tmp_path / f"state/commits/.{k}.crc").unlink(missing_ok=True)
        run(spark, tmp_path, seen, snapshot_every=1)
        assert seen[-1] == seen[-2] and state(spark, tmp_path) == before
    assert before == [("A1", 2, "same version"), ("A2", 3, "P")]
    kept = {kind: sorted(f.name for f in (tmp_path / "out" / kind).iterdir()) for kind in ("snapshots", "changes")}
    assert kept == {"snapshots": ["batch=2", "batch=3"], "changes": ["batch=3"]}


class Shelf:
    """A search service in a folder: an index is a folder, a document a file; some requests fail."""

    def __init__(self, top, broken=()):
        self.top, self.broken = str(top), broken

    def __call__(self):
        return self

    def _path(self, *names):
        import os

        return os.path.join(self.top, *names)

    def create(self, name, mapping):
        import os

        os.makedirs(self._path(name))

    def drop(self, name):
        import shutil

        shutil.rmtree(self._path(name))

    def point(self, alias, name):
        with open(self._path(f"{alias}.alias"), "w") as f:
            f.write(name)

    def count(self, name):
        import os

        return len(os.listdir(self._path(name)))

    def bulk(self, text):
        import json
        import os

        lines, rejected = text.rstrip("\n").split("\n"), []
        for head, body in zip(lines[::2], lines[1::2]):
            at = json.loads(head)["index"]
            if at["_id"] in self.broken:
                rejected.append(at["_id"])
                continue
            first = self._path(f"seen-{at['_id']}")
            if int(at["_id"][1:]) % 5 == 0 and not os.path.exists(first):  # too busy for some
                open(first, "w").close()
                rejected.append(at["_id"])
                continue
            with open(self._path(at["_index"], at["_id"]), "w") as f:
                f.write(body)
            if int(at["_id"][1:]) % 7 == 0 and not os.path.exists(f"{first}-lost"):  # the answer is lost on its way
                open(f"{first}-lost", "w").close()
                raise ConnectionError("lost")
        return rejected


def test_search_index_from_table_to_alias(spark, tmp_path):
    """Rejected documents and lost answers are sent again; nothing is lost or doubled; a failure leaves the alias."""
    import json

    from metapep.plans import builds
    from metapep.ranks import ENTRIES
    from metapep.sources.search_sink import SearchWriter, _Load

    rows = [(k, f"P{k % 60}", str(k % 9), k, "swissprot", f'na"me {k}', "ACD", "") for k in range(1, 101)]
    tsv.write_tsv(spark.createDataFrame(rows, ENTRIES).repartition(4), str(tmp_path / "entries"), compression="gzip")
    (tmp_path / "s").mkdir()
    shelf = Shelf(tmp_path / "s")
    name = builds.build_search_index(spark, str(tmp_path / "entries"), shelf, "entries", "2024.01", batch=7, wait=0.001)
    assert (tmp_path / "s/entries.alias").read_text() == name == "entries-2024-01"
    held = {f.name: json.loads(f.read_text()) for f in (tmp_path / "s" / name).iterdir()}
    want = {a: i for i, a, *_ in rows}  # the row with the largest id
    assert {a: d["taxon_id"] for a, d in held.items()} == want and held["P3"]["name"] == 'na"me 63'
    bad = Shelf(tmp_path / "s", broken=("P11",))
    with pytest.raises(Exception, match="not taken after 3 tries"):
        builds.build_search_index(spark, str(tmp_path / "entries"), bad, "entries", "2024.02", wait=0.001, tries=3)
    assert (tmp_path / "s/entries.alias").read_text() == name and not (tmp_path / "s/entries-2024-02").exists()
    # a task that runs again replaces what it has loaded
    shelf.create("again", {})
    writer = SearchWriter(_Load(shelf, "again", 3, 6, 0.001))
    documents = spark.createDataFrame([(f"P{k}", "{}") for k in range(10)], "accession string, document string").collect()
    messages = [writer.write(iter(documents)) for _ in range(2)]
    assert [m.documents for m in messages] == [10, 10] and messages[1].requests == 4 and shelf.count("again") == 10
    writer.commit(messages[:1])
    with pytest.raises(RuntimeError, match="holds 10 documents of 20"):
        writer.commit(messages)
