"""Reading, date windows, materialisation and the test-data views."""
