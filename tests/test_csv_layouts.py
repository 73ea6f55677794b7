"""Line breaks in quotes through the flow, and files of one source with headers of their own."""

import gzip
from dataclasses import replace

import pytest

from helpers import plan, rows
from sparkmart import schemas
from sparkmart.plans import warehouse
from sparkmart.sources import files
from test_flows import SETTINGS, sources  # noqa: F401

NAMES = schemas.CLIENTS.names


def written(path, names, rows):
    text = ",".join(names) + "\n" + "".join(",".join(row.get(n, "") for n in names) + "\n" for row in rows)
    data = text.encode("utf-8")
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)


def test_flow_reads_line_breaks_in_quotes(spark, sources, tmp_path):  # noqa: F811
    row = {"id_client": "C1", "nom": '"le\nGrand, C9"', "prenom": "sara", "email": "sara@x.ma"}
    written(tmp_path / "c.csv", NAMES, [row])
    own = replace(sources, clients=str(tmp_path / "c.csv"), multi_line=True)
    found = warehouse.extract(spark, own)["clients"].select("id_client", "nom", "prenom", "email").collect()
    assert [tuple(r) for r in found] == [("C1", "le\nGrand, C9", "sara", "sara@x.ma")]
    metrics = warehouse.run_warehouse(spark, own, str(tmp_path / "out"), phase="transform", settings=SETTINGS)
    assert metrics["extract"]["clients"] == 1 and metrics["transform"]["clients_clean"] == 1


def test_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    orders = [NAMES, NAMES[::-1], NAMES, [*NAMES[3:], "more", *NAMES[:3]]]
    for i, (name, names) in enumerate(zip(["a.csv", "b [1] %20 x.csv", "c.csv", "d.csv.gz"], orders)):
        written(folder / name, names, [{n: f"{n}-{i}-{k}" for n in names} for k in range(3)])
    (folder / "e.csv").write_text("")
    df = files.read_clients(spark, str(folder))
    assert df.columns == [*NAMES, files.ORDINAL]
    expected = sorted(tuple(f"{n}-{i}-{k}" for n in NAMES) for i in range(4) for k in range(3))
    assert sorted(tuple(r) for r in df.select(NAMES).collect()) == expected
    assert df.select(files.ORDINAL).distinct().count() == 12
    written(folder / "f.csv", NAMES[1:], [{}])
    with pytest.raises(ValueError, match="id_client"):
        files.read_clients(spark, str(folder))


def test_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    names = schemas.CLIENTS.names
    for i, own in enumerate((names, names[::-1])):
        blank = "\n" if i else ""
        (tmp_path / f"{i}.csv").write_text(blank + ",".join(own) + "\n" + "".join(",".join(f"{c}{i}{k}" for c in own) + "\n" for k in range(50)))
    plans, real = [], files.stored
    monkeypatch.setattr(files, "stored", lambda df: (plans.append(plan(df)), real(df))[1])
    read = files.read_clients(spark, str(tmp_path)).select(*names)
    assert rows(read) == sorted((tuple(f"{c}{i}{k}" for c in names) for i in range(2) for k in range(50)), key=repr)
    assert plans and not any("SortAggregate" in p or "Sort [" in p for p in plans)
