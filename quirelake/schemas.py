"""Schemas of the tables that the operators read and write, as DDL."""

AUTHOR = "struct<family: string, given: string>"
REGIONS = "doc_id string, page int, idx int, label string, native_label string, content string, bbox array<double>, image_path string"
REFS_RAW = "doc_id string, ref_idx int, page int, number string, text string"
REFS_EXTRACTED = f"doc_id string, ref_idx int, citation_key string, title string, authors array<{AUTHOR}>, year int, container_title string, volume string, page_range string, doi string"
CANDIDATES = f"doc_id string, cand_idx int, title string, year int, doi string, abstract string, authors array<{AUTHOR}>, source string, provider_type string"
MARKERS = "doc_id string, marker_no int, start int, end_at int, text string, ref_indices array<int>"
CHUNKS = "doc_id string, idx int, text string, page_start int, page_end int, overlap_chars int, overlap_mode string"
CROPS = "doc_id string, page int, crop_idx int, path string, bbox array<double>"
CAPTION_REGIONS = "doc_id string, page int, cap_idx int, text string, bbox array<double>"
