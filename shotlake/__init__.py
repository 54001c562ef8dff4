"""shotlake: analytics over shots, keyframes, speech, text and vectors of video, on Spark DataFrames."""
