"""Saved pages as a stream: the cursor, runs that are cut, and the command that watches."""

from datetime import date

import pytest
from helpers import month

from quarterlake.cli import main
from quarterlake.sources import savedpages, silver, snapshots
from quarterlake.workflows import sync


def page(*names):
    return "".join(f'<div><span class="informes-estudio-Titulo" title="Real Definitivo">t</span>Fecha de publicación: 05/04/2025<a href=\'/wp-content/uploads/{n}\'>ZIP</a></div>' for n in names)


def name(day, v=1):
    return f"Antecedentes_CMG_Real_def_2503{day:02d}{'' if v == 1 else f'_v{v}'}.zip"


def save(folder, day, lastmod, *names):
    savedpages.append_revision(folder, f"https://x/documentos/antecedentes-2503{day:02d}/", lastmod, f"d{day}-{lastmod[:10]}.html", page(*names))


def test_the_cursor_moves_after_success_only(spark, tmp_path, monkeypatch):
    folder, root = f"file://{tmp_path}/pages", f"file://{tmp_path}/out"
    run = lambda: sorted((r.nombre, str(r.fecha_operacion), r.revisado) for r in sync.sync(spark, folder, root, f"{root}/_cursor").collect())
    save(folder, 2, "2026-01-02T00:00", name(2))
    save(folder, 1, "2026-01-01T00:00", name(1))
    first = [(name(1), "2025-03-01", "2026-01-01T00:00"), (name(2), "2025-03-02", "2026-01-02T00:00")]
    assert run() == first and run() == first and snapshots.versions(spark, root) == [1]
    save(folder, 2, "2026-01-03T00:00", name(2), name(2, 2))

    def stop(*a):
        raise RuntimeError("cut short")

    with monkeypatch.context() as m:
        m.setattr(sync, "documents_of_revisions", stop)
        with pytest.raises(Exception, match="cut short"):
            run()
    assert snapshots.versions(spark, root) == [1]
    second = [first[0], (name(2), "2025-03-02", "2026-01-03T00:00"), (name(2, 2), "2025-03-02", "2026-01-03T00:00")]
    assert run() == second and snapshots.versions(spark, root) == [1, 2]

    real = snapshots.Transaction.commit
    save(folder, 3, "2026-01-03T00:00", name(3))

    def committed_then_cut(self, *a):
        real(self, *a)
        raise RuntimeError("cut short")

    with monkeypatch.context() as m:
        m.setattr(snapshots.Transaction, "commit", committed_then_cut)
        with pytest.raises(Exception, match="cut short"):
            run()
    third = [*second, (name(3), "2025-03-03", "2026-01-03T00:00")]
    assert run() == third and snapshots.versions(spark, root) == [1, 2, 3]


def test_the_log_of_revisions(tmp_path):
    folder = str(tmp_path / "p")
    assert savedpages.revisions(folder) == []
    save(folder, 1, "2026-01-01T00:00", name(1))
    with open(f"{folder}/revisiones.jsonl", "a") as f:
        f.write('{"loc": "cut')
    assert len(savedpages.revisions(folder)) == 1
    save(folder, 2, "2026-01-01T00:00", name(2))
    save(folder, 1, "2026-01-01T00:00", name(1))
    held = [(e["lastmod"], e["loc"][-3:]) for e in savedpages.revisions(folder)]
    assert held == [("2026-01-01T00:00", "01/"), ("2026-01-01T00:00", "02/")]
    assert len(savedpages.revisions(folder, ("2026-01-01T00:00", "https://x/documentos/antecedentes-250301/"))) == 1


def test_watching(spark, tmp_path, capsys):
    folder, root, base = f"file://{tmp_path}/pages", f"file://{tmp_path}/out", f"file://{tmp_path}/silver"
    save(folder, 1, "2026-01-01T00:00", name(1))
    silver.write_month(month(spark, 2025, 3, days=2, first=1).unionByName(month(spark, 2025, 3, first=5)), base, (2025, 3))
    found = sync.watch_source(spark, folder, root, root, silver.scan(spark, base), date(2025, 3, 1), date(2025, 3, 5))
    assert found["new"] == [name(1)] and found["documents"] == 1 and found["lines"][0].startswith("cobertura: 3 de 5")
    stopped = sync.watch_source(spark, folder, root, root, silver.scan(spark, base), date(2025, 3, 1), date(2025, 3, 5), lambda u: (200, ""), {"indice_url": "i", "dia_url": "d", "sitemap_url": "s", "anios": [2025], "marcadores": {}, "dia": date(2025, 3, 1), "documentos": []})
    assert stopped["new"] == [] and {f["tipo"] for f in stopped["findings"]} >= {"base_indice_sin_anios"}
    assert main(["vigilar", base, folder, root], spark) == 3 and "por descargar: 1" in capsys.readouterr().out
    assert main(["estado", base], spark) == 0 and "cobertura: 3 de 5 dias" in capsys.readouterr().out
