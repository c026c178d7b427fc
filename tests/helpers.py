"""Shared by the tests; a module of its own, so that no test imports a conftest."""

SF001 = "/root/testdata/sf0.001"
