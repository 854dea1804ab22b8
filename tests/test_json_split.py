"""One JSON document read in byte ranges gives what it gives as a whole, wherever it is cut."""

import copy
import json
import random

import numpy as np
import pytest

import small_shop
from trastienda.sources import erp, json_split, totals


def export():
    """A small export with escapes, braces in strings, nested values, and keys that look like blocks in other places."""
    whole = copy.deepcopy(small_shop.shop()["erp"])
    whole["snapshots"] = whole["snapshots"][:40]
    whole["tiendas_info"][0]["ciudad"] = 'a "quoted" {brace] \\ and \\" \n snapshots: ['
    whole["tiendas_info"][1]["más"] = {"snapshots": [{"fecha": "no"}], "x": [1, [2, {"y": "}"}]]}
    whole["metadata"]["nota \\"] = 'end\\'
    whole["otro"] = [{"tienda_id": "none"}, "snapshots", {"catalogo": {"productos": [{"sku_erp": "none"}]}}]
    whole["catalogo"] = {"versión": {"productos": "x"}, "productos": whole["catalogo"]["productos"], "después": [{"sku_erp": "none"}]}
    return whole


BLOCKS = (erp.stores, erp.sku_mappings, erp.products, erp.cost_history, erp.snapshots, erp.metadata)


def rows(documents):
    """All tables; nested values are text as it stands in the file, but for line breaks, which are blanks in JSON Lines."""
    found = {block.__name__: (block(documents).columns, sorted(str(r).replace("\\n", " ") for r in block(documents).collect())) for block in BLOCKS}
    return found | {"totals": sorted(map(str, totals.erp_totals(documents).collect()))}


@pytest.mark.parametrize("size, indent", [(157, None), (1000, 3), (1 << 20, None)])
def test_any_split_gives_the_whole_read(spark, tmp_path, monkeypatch, size, indent):
    monkeypatch.setattr(json_split, "TAIL_BYTES", 8)
    path = tmp_path / "in.json"
    path.write_text(json.dumps(export(), ensure_ascii=False, indent=indent), encoding="utf-8")
    lines = json_split.as_lines(spark, str(path), size)
    assert rows(erp.read_documents(spark, lines)) == rows(erp.read_documents(spark, str(path)))


def test_states_at_every_cut():
    """The functions of two parts, one after the other, give what the whole gives."""
    rng = random.Random(6)
    for _ in range(300):
        text = json.dumps({"".join(rng.choice('a"\\{}[]') for _ in range(rng.randrange(6))): [rng.choice(['\\', '"', "x\\\\", 1]), {"k": "\\\""}]})
        data = np.frombuffer(text.encode(), "u1")
        marks, after = json_split.quotes(data, 0)
        within, depth = json_split.levels(data, marks, 0, 0)
        assert (after, bool(within[-1]), int(depth[-1])) == (0, False, 0)
        for cut in range(1, len(data)):
            first, escaped = json_split.quotes(data[:cut], 0)
            second, _ = json_split.quotes(data[cut:], escaped)
            assert np.concatenate([first, second]).tolist() == marks.tolist()
            inside, level = json_split.levels(data[:cut], first, 0, 0)
            inside_after, level_after = json_split.levels(data[cut:], second, int(inside[-1]), int(level[-1]))
            assert np.concatenate([inside, inside_after]).tolist() == within.tolist() and np.concatenate([level, level_after]).tolist() == depth.tolist()


def test_a_broken_document_is_an_error(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"snapshots": [{"fecha": "2024-01-01"}', encoding="utf-8")
    with pytest.raises(Exception, match="isn't a whole JSON document"):
        json_split.as_lines(spark, str(tmp_path / "in.json"), 10)
