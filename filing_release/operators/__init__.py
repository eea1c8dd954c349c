"""Table operators: ``DataFrame -> DataFrame`` functions keyed on EIN."""
