from quarry.sources.delimited import header_names, parse_lines, read_lines, read_payloads  # noqa: F401
from quarry.sources.files import read_csv, read_documents  # noqa: F401
from quarry.sources.jdbc import read_table  # noqa: F401
