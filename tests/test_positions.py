from intakeyard.sources import positions


def test_positions_follow_file_order_across_many_splits(spark, lines_file):
    # tiny maxPartitionBytes (conftest) splits each file into many blocks and packs
    # several small files into one partition
    a = [f"a{i:05d}" + "x" * (i % 7) for i in range(1500)]
    b = [f"b{i}" for i in range(3)]
    c = [f"c{i:05d}" for i in range(800)]
    path = lines_file(a, b, c)
    df = positions.read_lines(spark, path, file_pos_col="file_line_no")
    assert df.rdd.getNumPartitions() > 3
    got = sorted((r.line_no, r.file_line_no, r.value) for r in df.collect())
    expected_values = a + b + c
    assert [g[0] for g in got] == list(range(1, len(expected_values) + 1))
    assert [g[2] for g in got] == expected_values
    file_pos = [g[1] for g in got]
    assert file_pos == list(range(1, 1501)) + [1, 2, 3] + list(range(1, 801))


def test_blank_lines_keep_their_position(spark, lines_file):
    path = lines_file(["x", "", "y", ""])
    got = sorted((r.line_no, r.value) for r in positions.read_lines(spark, path).collect())
    assert got == [(1, "x"), (2, ""), (3, "y"), (4, "")]
