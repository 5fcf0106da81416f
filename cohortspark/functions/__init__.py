"""Part of cohortspark."""
