"""Readers: extraction files, scanned documents, and connectors."""

from acervo.sources.files import read_documents, read_eav_csv, read_master_csv  # noqa: F401
from acervo.sources.pages import read_blocks, read_cells, read_images, read_signatures, write_images  # noqa: F401
from acervo.sources.service import register_service  # noqa: F401
