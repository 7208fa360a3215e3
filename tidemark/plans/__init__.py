"""Whole-model plans: the typed tables, the marts, their checks, and the build."""
