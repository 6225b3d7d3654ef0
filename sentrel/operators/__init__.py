"""One module per family of jobs; each job is DataFrame in, DataFrame out."""
