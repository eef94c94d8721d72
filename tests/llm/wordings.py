"""Usual licence wordings that no template holds, with their family; and sentences that are no licence."""

from __future__ import annotations

WORDINGS: list[tuple[str | None, str]] = [
    ("Apache-2.0", "Copyright 2019 Foo Authors. Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "This software is made available under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy at"),
    ("MIT", "This code is distributed under the MIT License, see LICENSE for details."),
    ("MIT", "Licensed under the terms of the MIT license."),
    ("MIT", "MIT License\n\nCopyright (c) 2020 Jane Roe"),
    ('MIT', 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE'),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted"),
    ("ISC", "This package is released under the ISC License."),
    ("GPL", "This program is licensed under the GNU General Public License v2.0 or later."),
    ("GPL", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"),
    ("GPL", "you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation"),
    ("LGPL", "Released under the GNU Lesser General Public License, version 3."),
    ("LGPL", "This module is free software under the terms of the GNU Lesser General Public License."),
    ("AGPL", "This server is licensed under the GNU Affero General Public License v3."),
    ("AGPL", "Released under the GNU AGPL: GNU Affero General Public License, version 3 or later."),
    ("BSD", "This library is distributed under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted."),
    ("BSD-2-Clause", "This tool is licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Distributed under the Simplified BSD License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain by its author."),
    ("CC0", "The data are dedicated to the public domain under CC0 1.0."),
    ("CC-BY", "The text is licensed under a Creative Commons Attribution 4.0 licence."),
    ("CC-BY-SA", "Content available under CC BY-SA 4.0 unless otherwise noted."),
    ("CC-BY-SA", "This page is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-SA", "This course is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-SA", "Shared under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND", "Shared under CC BY-NC-ND 4.0."),
    ("CC-BY-NC", "These images are licensed under CC BY-NC 4.0."),
    ("CC-BY-ND", "This work is available under CC BY-ND 4.0."),
    ("proprietary", "(c) Example Corp. All rights reserved worldwide."),
    ("GPL", "// SPDX-License-Identifier: GPL-2.0"),
    (None, "The public license plate office is open from nine to five."),
    (None, "He reserved all the rooms for the general and the free press of the city."),
    (None, "This work is about the history of the printing press, version two of the lecture."),
    (None, "Apache helicopters and the MIT museum were part of the tour under the bridge."),
    (None, "Everyone is permitted to enter the garden and to copy the plans of the house."),
]
