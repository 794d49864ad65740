"""The record normaliser and exact-key matcher on streams."""
