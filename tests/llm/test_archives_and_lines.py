import hashlib
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm.helpers import documents, frame, prose, same_rows
from pyarrow import fs

from postlode.llm import line_dedup, line_quality, warc


class TestWarc:
    PAGES = [
        (5, "http://a/1", "p" * 200), (2, "http://a/2", "p" * 200), (9, None, "p" * 200), (2, "http://a/2", "p" * 200),
        (3, "http://a/ü x\r\n", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", "p" * 200),
        (8, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9), (10, "u", "\x1f\x8b\x08" * 50),
    ]

    def test_round_trip(self, spark):
        pages = spark.createDataFrame([(*p, "d") for p in self.PAGES], "page_id long, url string, html string, digest string")
        read = warc.read_archives(warc.write_archives(warc.page_records(pages)), with_payload=True).where("gap is null")
        found = [
            (r.id, r.payload_bytes, r.payload_digest, r.record_type, r.to)
            for r in read.select("*", warc.page_number("record_id").alias("id"), warc.page_number("refers_to").alias("to")).collect()
        ]
        expected = []
        for i, _, html in self.PAGES:
            data = (html or "").encode()
            ids = [p[0] for p in self.PAGES if (p[2] or "").encode() == data and p[0] is not None]
            revisit = len(data) >= 100 and len(ids) > 1 and (i is None or i > min(ids))
            expected.append(
                (i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(ids) if revisit else None)
            )
        same_rows(found, expected)

    def test_empty_table(self, spark):
        pages = spark.createDataFrame([], "page_id long, url string, html string")
        assert warc.read_archives(warc.write_archives(warc.page_records(pages))).count() == 0

    @staticmethod
    def members(n: int, packed: bool) -> list[bytes]:
        import gzip

        raw = [
            warc.record_bytes(i, f"http://x/{i}", d := prose(i, 30).encode(), hashlib.sha256(d).hexdigest(), None)
            for i in range(n)
        ]
        return [gzip.compress(r) for r in raw] if packed else raw

    @staticmethod
    def read(data: bytes, start: int, end: int, packed: bool):
        return list(warc.salvage(pa.BufferReader(data), start, end, packed))

    @pytest.mark.parametrize("packed", [True, False])
    @pytest.mark.parametrize("harm", ["flip", "cut", "junk", "start", "end", "two"])
    def test_salvage_logs_each_gap_once(self, packed, harm):
        parts = self.members(12, packed)
        if harm == "flip":
            middle = len(parts[4]) - 20
            parts[4] = parts[4][:middle] + bytes([parts[4][middle] ^ 0x55]) + parts[4][middle + 1 :]
        elif harm == "cut":
            parts[4] = parts[4][:-30]
        elif harm == "junk":
            parts.insert(5, b"\x1f\x8b\x08 junk WARC/1.1\r\n junk")
        elif harm == "start":
            parts[0] = parts[0][10:]
        elif harm == "end":
            parts[-1] = parts[-1][:40]
        else:
            parts[3], parts[4] = parts[3][:-20], b"\0" * 300
        data = b"".join(parts)
        whole = self.read(data, 0, 1 << 40, packed)
        gaps = [g for g in whole if isinstance(g, tuple)]
        records = [r for r in whole if not isinstance(r, tuple)]
        assert len(gaps) == 1
        lost = {"junk": 0, "two": 2}.get(harm, 1)
        assert len(records) == 12 - lost
        covered = sorted([(r.at, r.end) for r in records] + [(a, b) for a, b, _ in gaps])
        assert covered[0][0] == 0 and covered[-1][1] == len(data)
        assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))
        if packed:
            for size in (64, 177, 1000):
                split = [x for at in range(0, len(data), size) for x in self.read(data, at, at + size, True)]
                assert [x for x in split if isinstance(x, tuple)] == gaps
                assert [r.at for r in split if not isinstance(r, tuple)] == [r.at for r in records]

    def test_damaged_files_through_spark(self, spark, folder):
        parts = self.members(40, True)
        parts[7] = parts[7][:50]
        local = fs.LocalFileSystem()
        with local.open_output_stream(f"{folder}/x.warc.gz", compression=None) as out:
            out.write(b"".join(parts))
        read = warc.read_archives(warc.archive_files(spark, folder), split_bytes=500).collect()
        assert sum(r.gap is None for r in read) == 39
        assert [(r.at, r.n_bytes) for r in read if r.gap] == [(sum(map(len, parts[:7])), 50)]


def base(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    again = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), n < 50 or 100 * len(inside) > 50 * n


class TestLineQuality:
    def test_base_counts_match_brute_force(self, spark):
        rows = [*documents(), (200, "a a a a"), (201, "x y z x y z\nx y z\n\n \n \n"), (202, "*#$ | <b> |")]
        found = line_quality.judge(frame(spark, rows, clashing=True)).collect()
        same_rows(
            [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found],
            [(i, *base(t)) for i, t in rows],
        )
        assert not any(r.kept and r.base_failed for r in found)

    @pytest.mark.parametrize(
        ("line", "rule"),
        [
            ("All rights reserved.", "boilerplate"), ("Licensed under the MIT License.", "boilerplate"),
            ("home | about | contact | login", "navigation"), ("Home About Contact", "navigation"),
            ("THIS!! IS!! LOUD!! TEXT!!", "punctuation"), ("word*** other$$$ third%%% more&&&", "punctuation"),
            ("so so so so so so so so so so so", "repetition"), ("A quiet line of prose, as it should be.", None),
            ("Title of a Page", None),
        ],
    )
    def test_rules(self, line, rule):
        assert line_quality.failing_rule(line.encode()) == rule

    def test_verdict(self, spark):
        good, bad = prose(1, 80), "LOUD!! " * 80
        unique_bad = " ".join(f"W{i}A!!" for i in range(70))
        rows = [(1, good), (2, bad), (3, f"{good}\n{unique_bad}"), (4, f"{unique_bad}\n{prose(3, 20)}"), (5, f"All rights reserved.\n{good}")]
        found = {r.doc_id: r for r in line_quality.judge(frame(spark, rows)).collect()}
        assert [found[i].kept for i in (1, 2, 3, 4, 5)] == [True, False, True, False, True]
        assert found[5].clean_text == good and found[3].n_lost_words == 70

    def test_empty_table(self, spark):
        assert line_quality.judge(frame(spark, [])).count() == 0


def brute_lines(rows: list[tuple], min_chars: int, min_docs: int) -> list[tuple]:
    holders: dict[str, set] = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(x.strip(" \t\n\r\x0b\x0c").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})), set()).add(i)
    out = []
    for i, t in rows:
        lines, kept = (t or "").split("\n"), []
        for x in lines:
            k = x.strip(" \t\n\r\x0b\x0c").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))}))
            who = holders[k]
            keeper = max(who, key=lambda d: (d is not None, d or 0))
            if not (len(k) >= min_chars and len(who) >= min_docs and i != keeper):
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


class TestLineDedup:
    @pytest.mark.parametrize(("chars", "docs"), [(40, 5), (3, 2), (1, 3)])
    def test_matches_brute_force(self, spark, chars, docs):
        rows = [*documents(), (300, "tie one\nTIE ONE \n tie one"), (301, "tie one"), (302, "x\ntie one\ntie one")]
        found = line_dedup.digests(frame(spark, rows, clashing=True), min_chars=chars, min_docs=docs).collect()
        same_rows(found, brute_lines(rows, chars, docs))

    def test_hot_line_over_many_partitions(self, spark):
        rows = [(i, "a line that every document of this table holds\nown line %d" % i) for i in range(400)]
        found = line_dedup.digests(frame(spark, rows).repartition(9)).collect()
        same_rows(found, brute_lines(rows, 40, 5))

    def test_columns_stay(self, spark):
        rows = documents()
        kept = line_dedup.without_repeats(frame(spark, rows, clashing=True))
        assert kept.columns == frame(spark, [], clashing=True).columns
        assert kept.count() == len(rows)
        assert kept.where("text is null").count() == sum(t is None for _, t in rows)

    def test_empty_table(self, spark):
        assert line_dedup.digests(frame(spark, [])).count() == 0

    def test_bitmap_keeps_lines_beyond_its_end(self):
        packed = line_dedup._pack([1, 9])
        assert line_dedup.keep_mask(packed, 30).tolist() == [i not in (1, 9) for i in range(30)]
