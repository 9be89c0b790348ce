from .catalog import (read_catalog, read_lines, read_object, read_source,
                      scan_with_rejects, source_points, write_catalog)
from .schemas import object_schema, source_schema
from .testdata import document_lines, sky_points

__all__ = ["read_catalog", "read_lines", "read_object", "read_source",
           "scan_with_rejects", "source_points", "object_schema", "source_schema",
           "document_lines", "sky_points", "write_catalog"]
