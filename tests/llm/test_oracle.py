"""The registered queries: with SQL, the same rows as DuckDB; without, the promised columns."""

from pathlib import Path

import duckdb
import pytest

from paylake.llm import queries

PROMISED = {
    "op1_html_text": "page_id url text n_chars",
    "op2_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3_token_files": "doc_id start n_tokens ids_crc32",
    "op4_pieces": "doc_id n_pieces",
    "op5_quality": "doc_id held_out score predicted",
    "op6_near_duplicates": "doc_id n_shingles component_id kept",
    "op7_decontamination": "doc_id item_id",
    "op8_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_phrases": "lang rank phrase a l r n score",
    "op13_token_counts": "doc_id n_bytes n_tokens over_limit",
}


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(
        map(repr, want.fetchall())
    )


def test_every_operator_has_a_query():
    assert set(queries.queries()) == set(PROMISED)


@pytest.mark.parametrize("name", list(PROMISED))
def test_one_row_per_input_row_with_the_promised_columns(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    assert set(PROMISED[name].split()) <= set(got.columns)
    table = "pages" if name == "op1_html_text" else "documents"
    if name not in ("op7_decontamination", "op12_phrases"):
        key = "page_id" if table == "pages" else "doc_id"
        ids = sorted(r[0] for r in got.select(key).collect())
        assert ids == sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())
