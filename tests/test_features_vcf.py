import gzip

import pytest

from svweave.operators import vcf
from svweave.sources.features import read_features


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def features_of(text, fixed=None, keys=("action",)):
    """Line after line, for well-formed files."""
    action, out = fixed or "none", []
    for line in text.split("\n"):
        if line.startswith("track"):
            action = next((v for k in keys for w in line.split() for v in [w.partition("=")[2].strip("\"'")] if w.startswith(k + "=")), "none")
            action = {"ignore": "ignore", "filter:reads": "filter", "annotate:transposon": "annotate"}.get(action, action)
        elif line and line[0] != "#" and not line.startswith("browser") and action != "none":
            f = line.split()
            if "\t" in line:
                out.append((action, f[0], int(f[1]), int(f[2]), f[3] if len(f) > 3 else ""))
            else:
                c, _, r = line.rpartition(":")
                out.append((action, c, int(r.split("-")[0]) - 1, int(r.split("-")[1]), ""))
    return sorted(out)


def test_features_follow_the_last_track(spark, tmp_path):
    tracks = ["track name=x action=ignore", "track action='filter:reads' name=\"a b\"", "track name=none", 'track\tother=1 action="annotate:transposon"']
    lines = ["chr1\t5\t9\tskipped", "# comment", "", "browser position"]
    for k in range(400):
        lines += [tracks[(k // 23) % 4]] if k % 23 == 0 else []
        lines.append(f"chr{k % 3}\t{k}\t{k + 10}\tn{k}\textra" if k % 3 else f"chr{k % 5}:{k + 1}-{k + 9}" if k % 2 else f"c\t{k}\t{k + 1}")
    text = "\n".join(lines) + "\n"
    (tmp_path / "a.bed").write_text(text)
    with gzip.open(tmp_path / "b.bed.gz", "wt") as f:
        f.write(text)
    want = features_of(text)
    assert len(want) > 200
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many blocks, some without a track
    try:
        assert rows(read_features(spark, str(tmp_path / "a.bed"))) == want
        assert rows(read_features(spark, str(tmp_path))) == sorted(want * 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert rows(read_features(spark, str(tmp_path / "b.bed.gz"))) == want


def test_feature_rules(spark, tmp_path):
    def read(text, fixed=None, keys=("action",)):
        path = tmp_path / f"f{len(list(tmp_path.iterdir()))}.bed"
        path.write_text(text)
        return rows(read_features(spark, str(path), fixed, keys))

    assert read("1\t2\t3\n", fixed="ignore") == [("ignore", "1", 2, 3, "")]
    assert read("track own=ignore action=filter:reads\n1\t2\t3\n", keys=("own", "action")) == [("ignore", "1", 2, 3, "")]
    assert read('track action="ig\\nore"\n1\t2\t3\n') == [("ignore", "1", 2, 3, "")]
    for text, fixed, said in (("track action=what\n1\t2\t3\n", None, "unknown action"), ("track action=ignore\n1\t2\n", None, "too few"), ("track action=ignore\nchr1\n", None, "neither"), ("track action=ignore\n1\t2\t3\n", "filter", "another action"), ("track\n1\t2\t3\n", "filter", "another action"), ("1\t2\t3\n", None, "no features")):
        with pytest.raises(Exception, match=said):
            read(text, fixed)


RECORD = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string, format string, normal string, tumour string"


def test_combined_records(spark, tmp_path):
    old = [("1", 10, "7_1", "N", "<B>", "9", ".", "A=1;BKDIST=5;TSRDS=x,y", "RC", "3", "4"), ("2", 20, "7_2", "N", "<B>", "9", ".", "A=1", "RC", "3", "5"), ("1", 5, "8_1", "N", "<B>", "9", ".", "BKDIST=-1;Z=2", "RC", "0", "1"), ("3", 6, "8_2", "N", "<B>", "9", ".", "Z=2;TSRDS=q", "RC", "0", "2")]
    new = [("1", 12, "7_1", "G", "G[", "77", ".", "B=2;", "PS", "0", "6"), ("3", 6, "8_2", "C", "]C", "50", ".", "", "PS", "0", "1")]
    classes = spark.createDataFrame([("7", 44, "deletion"), ("8", -1, "translocation")], "id string, bkptdist long, svclass string")
    table, assembled = spark.createDataFrame(old, RECORD), spark.createDataFrame(new, RECORD)
    got = rows(vcf.combine_vcf(table, assembled, classes))
    assert got == sorted([
        ("1", 12, "7_1", "G", "G[", ".", ".", "B=2;TSRDS=x,y;BAS=77;BKDIST=44;SVCLASS=deletion", "RC:PS", "0:3", "6:4"), ("2", 20, "7_2", "N", "<B>", "9", ".", "A=1;BKDIST=44;SVCLASS=deletion", "RC:PS", "0:3", "0:5"),
        ("1", 5, "8_1", "N", "<B>", "9", ".", "BKDIST=-1;Z=2;BKDIST=-1;SVCLASS=translocation", "RC:PS", "0:0", "0:1"), ("3", 6, "8_2", "C", "]C", ".", ".", ";TSRDS=q;BAS=50;BKDIST=-1;SVCLASS=translocation", "RC:PS", "0:0", "1:2"),
    ])
    for records, other, known, said in ((table.filter("id <> '8_1'"), assembled, classes, "two records"), (table, assembled, classes.filter("id <> '8'"), "no class"), (table, assembled.union(assembled), classes, "more than once")):
        with pytest.raises(Exception, match=said):
            vcf.combine_vcf(records, other, known).collect()
    header = vcf.combine_header(["##fileformat=VCFv4.1", "##INFO=<ID=X>", "##INFO=<ID=Y>", "##FORMAT=<ID=RC>", "##SAMPLE=<ID=TUMOUR,Name=t>"], "Purity=0.7")
    assert header == ["##fileformat=VCFv4.1", *vcf.NEW_INFO, "##INFO=<ID=X>", "##INFO=<ID=Y>", vcf.NEW_FORMAT, "##FORMAT=<ID=RC>", "##SAMPLE=<ID=TUMOUR,Name=t,Purity=0.7>"]
    vcf.write_vcf(table, header, str(tmp_path / "out"))
    written = [f.read_text().splitlines() for f in sorted((tmp_path / "out").glob("part-*")) if f.stat().st_size]
    assert all(w[: len(header)] == header and w[len(header)].startswith("#CHROM") for w in written)
    assert [line.split("\t")[2] for w in written for line in w[len(header) + 1 :]] == ["8_1", "7_1", "7_2", "8_2"]
