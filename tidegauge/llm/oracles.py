"""SQL oracles of the queries that DuckDB can state; the others are tested against brute force."""

from tidegauge.llm import jaccard_groups, license_scan, phrase_index, phrase_mining, prefix_trie

ORACLES = {
    "op6_jaccard_groups": jaccard_groups.ORACLE,
    "op9_phrase_decontamination": phrase_index.ORACLE,
    "op11_setm_collocations": phrase_mining.ORACLE,
    "op12_license_diagonals": license_scan.ORACLE,
    "op13_zfast_trie": prefix_trie.ORACLE,
}
