"""Reading: pages, responses, delimited files, table rows, the document index, held files."""
