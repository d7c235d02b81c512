"""Folders of the test tables."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
