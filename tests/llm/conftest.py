"""Tests of the operators use the session of the other tests."""
