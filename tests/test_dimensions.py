import pytest

from noticeworks.operators.contracts import ContractError
from noticeworks.sources import dimensions


def test_vocabulary_and_its_tree(spark, tmp_path):
    codes = ["03000000", "03200000", "03210000", "03212000", "03212200", "03212210", "03212211", "30000000", "30120000", "45110000", "0321", "00000000", "03210200"]
    (tmp_path / "v.csv").write_text("code,nombre,name\n" + "".join(f'{c},"n, {c}", \n' for c in codes))
    got = {r.cpv_code: r for r in dimensions.read_code_dimension(spark, str(tmp_path / "v.csv")).collect()}
    assert set(got) == set(codes[:10])
    assert [got[c].level for c in codes[:8]] == [1, 2, 3, 4, 5, 6, 7, 1]
    assert [got[c].parent_code for c in codes[:10]] == [None, *codes[:6], None, "30000000", None]
    assert {c for c, r in got.items() if r.is_leaf} == {"03212211", "30120000", "45110000"} and got["03000000"].label_en is None
    assert dimensions.empty_code_dimension(spark).count() == 0
    (tmp_path / "w.csv").write_text("code,nombre\n1,x\n")
    with pytest.raises(ContractError):
        dimensions.read_vocabulary(spark, str(tmp_path / "w.csv"))


def test_units_by_header_names(spark):
    head = ["C_ID_UD_ORGANICA", "C_DNM_UD_ORGANICA", "C_ID_NIVEL_ADMON", "X", "N_NIVEL_JERARQUICO", "C_ID_DEP_UD_SUPERIOR", "C_DNM_UD_ORGANICA", "C_ID_DEP_UD_PRINCIPAL", "C_ID_ESTADO", "D_VIG_ALTA_OFICIAL", "NIF_CIF"]
    good = ["EA0000001", "own name", "1", "x", "2", "EA0000002", "parent name", "EA0000003", "V", "01/02/20", "s28a"]
    bad = [*good[:2], "2", *good[3:]]
    rows = [("f", n, {chr(66 + i): v for i, v in enumerate(r)}) for n, r in ((2, head), (3, good), (4, bad), (5, []))]
    accepted, rejected = dimensions.units(spark.createDataFrame(rows, "path string, row int, cells map<string,string>"), "1")
    assert [tuple(r) for r in accepted.collect()] == [("EA0000001", "own name", "1", 2, "EA0000002", "EA0000003", "V", "01/02/20", "S28A")]
    assert {(r.row, r.rejection_reason) for r in rejected.collect()} == {(4, "nivel_admin_mismatch"), (5, "missing_dir3_code")}
