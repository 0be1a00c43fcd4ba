"""Row, table-generating, join and aggregate operators over documents and chunks."""
