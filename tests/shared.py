"""Values that several test modules use; a plain module, so that further conftest files can't hide it."""

SF_SMALL = "/root/testdata/sf0.001"
