"""Queries of the subpackage's operators and the SQL they are compared with."""

from __future__ import annotations

from millrace.llm import encoding, langid, linking, matching, mixing, repeats, residue

QUERIES = {"p3_found": matching.p3_found, "p3_misses": matching.p3_misses, "p7_found": linking.p7_found, "p7_members": linking.p7_members,
    "p8_ids": encoding.p8_ids, "p8_decoded": encoding.p8_decoded, "p10_found": langid.p10_found, "p10_documents": langid.p10_documents,
    "p1_found": residue.p1_found, "p6_found": residue.p6_found, "p5_found": repeats.p5_found, "p5_incremental": repeats.p5_incremental, "p9_mixture": mixing.p9_mixture, "p9_shares": mixing.p9_shares}
SQL: dict[str, str] = {"p8_decoded": encoding.DECODED_SQL}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
