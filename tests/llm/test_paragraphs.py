import random

import numpy as np

from blotter.llm import queries as Q
from blotter.llm.paragraphs import BANDS, ROWS, Units, bands_for, shingle_set, substring_dedup
from fixtures import awkward, frame, text, words


def spans(rows):
    return sorted((r.doc_id, r.first_word, r.n_words, r.kept) for r in rows)


def test_band_count_gives_the_recall():
    assert BANDS == bands_for() and 1 - (1 - 0.8 ** ROWS) ** BANDS >= 0.998


def test_equal_paragraph_in_two_documents(spark):
    shared = text(70, 1)
    rows = [(1, text(30, 2) + "\n" + shared, "", ""), (2, shared + "\n" + text(90, 3), "", ""), (3, text(200, 4), "", "")]
    got = substring_dedup(frame(spark, rows)).collect()
    by = {r.doc_id: r for r in got}
    assert sorted(r.doc_id for r in got) == [1, 2]
    assert (by[1].first_word, by[1].n_words) == (30, 70) and by[2].n_words == 70
    assert sorted(r.kept for r in got) == [False, True]


def test_passage_inside_other_words_is_found(spark):
    r, rows = random.Random(7), []
    passages = [text(52, 1000 + k) for k in range(20)]
    for i in range(100):
        w = words(r.randint(60, 200), i)
        at = r.randrange(len(w))
        rows.append((i, " ".join(w[:at] + [passages[i % 20]] + w[at:]) if i < 60 else " ".join(w), "", ""))
    got = {r.doc_id for r in substring_dedup(frame(spark, rows)).collect()}
    assert got == set(range(60))


def test_similar_paragraphs_are_verified_exactly(spark):
    base = words(100, 1)
    near = list(base)
    near[50] = "changed"            # 5 of 96 shingles differ: Jaccard 91 / 101
    far = list(base)
    for k in (10, 30, 50, 70, 90):  # 25 of 96 differ: Jaccard 71 / 121
        far[k] = "changed"
    # Distinct words around and no content-defined passage in common.
    a, b, c = (shingle_set(" ".join(x).encode()) for x in (base, near, far))
    assert len(a & b) / len(a | b) >= 0.8 > len(a & c) / len(a | c)
    rows = [(1, " ".join(base), "", ""), (2, " ".join(near), "", "")]
    got = {r.doc_id: r for r in substring_dedup(frame(spark, rows)).collect()}
    assert got[1].n_words == got[2].n_words == 100
    assert got[1].kept != got[2].kept


def test_chain_of_similar_paragraphs_is_one_component(spark):
    """A bucket whose members are linked through others only."""
    rows, w = [], words(120, 3)
    for i in range(12):
        rows.append((i, " ".join(w), "", ""))
        w = list(w)
        w[i * 9 + 4] = f"other{i}"
    got = substring_dedup(frame(spark, rows)).collect()
    whole = [r for r in got if r.n_words == 120]
    assert {r.doc_id for r in whole} == set(range(12))
    assert sum(r.kept for r in whole) == 1


def test_repeats_inside_one_document_only_without_across(spark):
    p = text(60, 5)
    df = frame(spark, [(1, p + "\n" + p, "", ""), (2, text(80, 6), "", "")])
    assert substring_dedup(df).collect() == []
    assert {r.doc_id for r in substring_dedup(df, across=False).collect()} == {1}


def test_awkward_rows(spark):
    got = substring_dedup(frame(spark, awkward())).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4}
    assert sum(1 for r in got if r.doc_id == 2) >= 2
    assert all(r.n_words >= 20 for r in got)


def test_units_do_not_reach_over_texts():
    a, b = text(80, 1), text(80, 2)
    alone = set(Units([a.encode()]).digest.tolist())
    both = Units([a.encode(), b.encode(), b"", b"x"])
    assert alone == set(both.digest[both.owner == 0].tolist())
    assert set(Units([b.encode()]).digest.tolist()) == set(both.digest[both.owner == 1].tolist())


def test_signature_agreement_estimates_jaccard():
    base = words(400, 1)
    near = [w if i % 60 else "other" for i, w in enumerate(base)]
    u = Units([" ".join(base).encode(), " ".join(near).encode()])
    assert u.bands.shape == (2, BANDS)
    assert 1 <= np.sum(u.bands[0] == u.bands[1])


def test_empty_table(spark):
    assert substring_dedup(frame(spark, []).limit(0)).collect() == []


def test_query_finds_every_document_that_shares_51_words(spark, sf_small):
    docs = {d.doc_id: (d.text or "").lower().split() for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    seen: dict[tuple, set] = {}
    for i, w in docs.items():
        for k in range(len(w) - 50):
            seen.setdefault(tuple(w[k:k + 51]), set()).add(i)
    truth = set().union(*[s for s in seen.values() if len(s) > 1])
    # Nothing is reported without five words that stand twice somewhere.
    places: dict[tuple, list] = {}
    for i, w in docs.items():
        for k in range(len(w) - 4):
            places.setdefault(tuple(w[k:k + 5]), []).append(i)
    some = {i for at in places.values() if len(at) > 1 for i in at}
    got = {r.doc_id for r in Q.op1_substring_dedup(spark, sf_small).collect()}
    assert truth <= got <= some


def test_matrix_jaccard_equals_sets():
    from blotter.llm.paragraphs import jaccard_near
    r = random.Random(4)
    paragraphs = []
    for i in range(30):
        w = words(r.randint(1, 90), i % 4)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "x"
        paragraphs.append(" ".join(w).encode())
    a, b = paragraphs[:13], paragraphs[13:]
    keys = [[r.randrange(4) for _ in range(BANDS)] for _ in paragraphs]
    payload = [np.array(k, ">i8").tobytes() + p for k, p in zip(keys, paragraphs)]
    sets = [[shingle_set(p) for p in side] for side in (a, b)]
    for columns in (7, 1 << 13):
        for table in (0, 2):
            got = jaccard_near(0.8, columns)(table, ([], payload[:13]), ([], payload[13:]))
            assert got.tolist() == [[len(x & y) >= 0.8 * len(x | y) and all(
                keys[i][t] != keys[13 + j][t] for t in range(table)) for j, y in enumerate(sets[1])]
                for i, x in enumerate(sets[0])]


def test_large_buckets_against_all_pairs(spark, monkeypatch):
    """Many edited copies: stretches are short, so the later pass does the work."""
    import blotter.llm.buckets as module
    monkeypatch.setattr(module, "STRETCH", 8)
    monkeypatch.setattr(module, "STRETCH_BYTES", 4000)
    r = random.Random(9)
    rows, sets = [], []
    for i in range(90):
        w = words(110, i % 3)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(5, 105)] = f"edit{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "", ""))
        sets.append(shingle_set(" ".join(w).encode()))
    from fixtures import components
    root = components(90, [(a, b) for a in range(90) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    got = [x for x in substring_dedup(frame(spark, rows)).collect() if x.n_words == 110]
    # One whole paragraph is kept per component; components of one are not reported whole.
    sizes = {g: root.count(g) for g in set(root)}
    assert sum(x.kept for x in got) == sum(n > 1 for n in sizes.values())
    assert {x.doc_id for x in got} == {i for i in range(90) if sizes[root[i]] > 1}


def test_short_lines_are_linked_when_equal_or_similar(spark):
    """Fewer than 50 words: thirty equal ones, forty with one word inserted."""
    line, other = words(30, 1), words(48, 2)
    rows = [(i, f"{text(60, 10 + i)}\n{' '.join(w)}\n{text(60, 20 + i)}", "", "") for i, w in enumerate(
        [line, line, ["x", *other[1:]], other[:47] + ["y"]])]
    got = spans(substring_dedup(frame(spark, rows)).collect())
    assert [g for g in got if g[0] < 2] == [(0, 60, 30, True), (1, 60, 30, False)]
    assert [g for g in got if g[0] >= 2 and g[2] == 48] == [(2, 60, 48, True), (3, 60, 48, False)]


def test_wrapped_lines_are_one_paragraph(spark):
    base = words(90, 1)
    near = base[:44] + ["changed"] + base[45:]

    def wrapped(w, width):
        return "\n".join(" ".join(w[k:k + width]) for k in range(0, len(w), width))

    rows = [(1, wrapped(base, 4) + "\n \n" + wrapped(words(40, 2), 4), "", ""),
            (2, wrapped(words(40, 3), 4) + "\n\n" + wrapped(near, 3), "", "")]
    got = spans(substring_dedup(frame(spark, rows)).collect())
    assert [g for g in got if g[2] >= 90] == [(1, 0, 90, True), (2, 40, 90, False)]


def test_every_repeat_of_35_words_holds_an_equal_passage():
    """Inside differing lines, also with a period; no chance is left to borders."""
    for k in range(300):
        shared = words(35, k) if k % 3 else (words(1 + k % 5, k) * 35)[:35]
        texts = [" ".join(words(40 + k % 7, 1000 * j + k) + shared + words(50, 5000 * j + k + 1)).encode() for j in (1, 2)]
        u = Units(texts)
        at = (40 + k % 7 <= u.first_word) & (u.first_word + u.end - u.start <= 75 + k % 7) & ~u.is_paragraph
        assert (u.end - u.start)[at].min() >= 20
        assert set(u.digest[at & (u.owner == 0)]) & set(u.digest[at & (u.owner == 1)])


def test_passages_are_those_of_the_definition():
    from blotter.llm.paragraphs import SPACING, SPAN
    t = " ".join(words(400, 3) + words(3, 4) * 20)
    u = Units([b"some other words", t.encode(), text(25, 5).encode()])
    starts = u.first_word[(u.owner == 1) & ~u.is_paragraph]
    gaps = np.diff(starts)
    assert starts[0] == 0 and starts[-1] == 460 - SPAN and gaps.min() >= 1 and gaps.max() <= SPACING
    assert ((u.end - u.start)[~u.is_paragraph] == SPAN).all() and (u.owner[~u.is_paragraph] > 0).all()
    assert len(starts) < 440 / 4


def test_query_reports_paragraphs_repeated_in_one_document(spark, tmp_path):
    p, edited = text(200, 5), words(200, 5)
    edited[100] = "changed"
    rows = [(1, "\n".join([p, text(30, 7), p, p, " ".join(edited)]), "", ""), (2, text(80, 6), "", "")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = spans(Q.op1_substring_dedup(spark, str(tmp_path)).collect())
    # Words over the border of two copies stand twice as well; their first place is kept.
    assert [g for g in got if not g[3]] == [(1, 230, 600, False)]
    assert got[0] == (1, 0, 200, True) and {g[0] for g in got} == {1}


def test_longest_line_of_a_kept_paragraph_is_kept_with_it(spark):
    """The paragraph of both lines and the long line alone are similar."""
    both = text(6, 1) + "\n" + text(200, 2)
    rows = [(1, both, "", ""), (2, text(50, 3) + "\n\n" + both, "", ""), (3, text(5, 4) + "\n" + text(150, 5), "", "")]
    got = spans(substring_dedup(frame(spark, rows), own_words=50).collect())
    assert got == [(1, 0, 206, True), (2, 50, 206, False)]


def test_query_reports_short_repeats_in_and_across_documents(spark, tmp_path):
    line, para = text(19, 1), text(40, 2)
    rows = [(1, text(60, 10) + "\n" + line, "", ""), (2, line + "\n" + text(50, 11), "", ""),
            (3, para + "\n" + text(30, 12) + "\n" + para, "", ""), (4, "just four short words\n" * 3, "", ""), (5, text(80, 13), "", "")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = spans(Q.op1_substring_dedup(spark, str(tmp_path)).collect())
    assert [g for g in got if g[0] < 4] == [(1, 60, 19, True), (2, 0, 19, False), (3, 0, 40, True), (3, 70, 40, False)]
    assert {g[0] for g in got} <= {1, 2, 3, 4}


def test_query_against_all_pairs_of_paragraphs(spark, tmp_path):
    """Lines of a small table, every pair compared: the documents with a span
    and the clusters are those of the definition."""
    from fixtures import components, split
    r, rows, pool = random.Random(5), [], [words(r_n, 300 + k) for k, r_n in enumerate([6, 8, 13, 19, 25, 40, 60])]
    for i in range(40):
        lines = []
        for j in range(3):
            w = list(r.choice(pool)) if r.random() < 0.5 else words(r.randint(5, 40), 10_000 + 10 * i + j)
            if r.random() < 0.4:
                w[-1] = f"end{i}"
            lines.append(" ".join(w))
        rows.append((i, "\n\n".join(lines), "", ""))
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    units = [(i, t) for i, text_, *_ in rows for t in text_.lower().split("\n\n")]
    sets = [shingle_set(t.encode()) for _, t in units]
    links = [(a, b) for a in range(len(units)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = components(len(units), links)
    sizes = {g: group.count(g) for g in group}
    want = {u[0] for u, g in zip(units, group) if sizes[g] > 1}
    got = Q.op1_substring_dedup(spark, str(tmp_path)).collect()
    assert {g.doc_id for g in got} == want
    removed = sum(g.n_words for g in got if not g.kept)
    firsts = {min(k for k, x in enumerate(group) if x == g) for g in group}
    assert removed == sum(len(split(units[k][1])) for k in range(len(units)) if sizes[group[k]] > 1 and k not in firsts)


def test_pairs_with_the_first_of_a_bucket_are_compared_once(spark, monkeypatch):
    """Half similar lines that share a band with one other line each: the pair
    has been checked as a candidate and needs no second look."""
    import blotter.llm.paragraphs as module
    seen, real = [], module.joined_buckets

    def look(open_rows, *rest):
        seen.append([(x.table, x.key) for x in open_rows.collect()])
        return real(open_rows, *rest)

    monkeypatch.setattr(module, "joined_buckets", look)
    lines = []
    for k in range(12):
        w = words(60, k)
        lines += [" ".join(w), " ".join(w[:45] + words(15, 100 + k))]
    u = Units([x.encode() for x in lines])
    assert (u.bands[::2] == u.bands[1::2]).any()
    substring_dedup(frame(spark, [(i, x, "", "") for i, x in enumerate(lines)])).collect()
    assert len(seen) == 1 and seen[0] and len(set(seen[0])) == len(seen[0])  # one row of a bucket: no pair


def test_scratch_tables_go_after_their_last_reader(spark, monkeypatch):
    """Units and the payloads of large buckets are most of the disk."""
    import os

    import blotter.llm.buckets as buckets
    import blotter.llm.paragraphs as module
    made, real = {}, module.cut

    def noted(df, name, into=None):
        out = real(df, name, into)
        made.setdefault(name, []).extend(f.removeprefix("file://") for f in out.inputFiles())
        return out

    monkeypatch.setattr(module, "cut", noted)
    monkeypatch.setattr(buckets, "cut", noted)
    r, rows = random.Random(9), []
    for i in range(90):
        w = words(110, i % 3)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(5, 105)] = f"edit{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "", ""))
    assert len(substring_dedup(frame(spark, rows)).collect()) > 3
    for name in ("units", "repeats", "open_rows", "mixed_rows", "stretches"):
        assert made[name] and not [f for f in made[name] if os.path.exists(f)], name
    assert all(os.path.exists(f) for f in made["places"])
