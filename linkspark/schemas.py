"""Schemas of the tables between stages. The names are those of the files and of the matcher's inputs."""

from __future__ import annotations

RECORD = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"
PAIR = "s1_id string, cand_id string"
DICTIONARY = "kind string, country string, noisy string, canon string"
CLEAN_COLUMNS = [
    "entity_id", "business_name", "business_address", "country",
    "name_clean", "name_core", "name_alias", "name_legal", "f_name_domain", "f_name_alias",
    "addr_clean", "addr_comps", "addr_landmark", "addr_nums", "addr_first_num", "addr_postcode",
    "f_name_native", "f_addr_native", "f_name_caps", "f_addr_caps", "f_addr_empty", "f_name_junk",
]
CANDIDATE = "s1_id string, cand_id string, cos_name double, cos_addr double, score double, rank int"
