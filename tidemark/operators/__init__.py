"""DataFrame operators: columns, snapshots, joins, growth, sizes, quality."""
