"""Notices by which works name their licence, by family, and texts that name none.

``NOTICES`` are the customary notices of public licences, in their own words. The other
texts were written for training: ``OTHER_TERMS`` set terms of no listed family, and
``NO_TERMS`` speak of licences or use their words without setting any.
"""

from __future__ import annotations

NOTICES: dict[str, tuple[str, ...]] = {
    "mit": (
        "SPDX-License-Identifier: MIT",
        "Released under MIT.",
        "MIT License",
        "Distributed under the MIT licence.",
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    "apache": (
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License",
        "Apache 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "gpl": (
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU General Public License",
        "This code is under the GPL version 2.",
        "GNU GPL",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "Released under the GPL v2.",
        "Licensed under GPLv3 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "SPDX-License-Identifier: LGPL-2.1-only",
        "GNU Lesser General Public License",
        "This code is under the LGPL version 2.1.",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation.",
        "Released under the LGPL.",
    ),
    "agpl": (
        "SPDX-License-Identifier: AGPL-3.0-only",
        "GNU Affero General Public License",
        "This code is under the AGPL version 3.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation.",
        "Released under the AGPL.",
    ),
    "bsd": (
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD License",
        "Distributed under the BSD licence.",
        "Released under the BSD License.",
        "Licensed under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ),
    "mpl": (
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the MPL 2.0.",
    ),
    "epl": (
        "SPDX-License-Identifier: EPL-2.0",
        "Eclipse Public License",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 1.0.",
    ),
    "isc": (
        "SPDX-License-Identifier: ISC",
        "ISC License",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "cc-by": (
        "SPDX-License-Identifier: CC-BY-4.0",
        "Creative Commons Attribution",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd": (
        "SPDX-License-Identifier: CC-BY-ND-4.0",
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "public-domain": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "all-rights-reserved": (
        "Copyright 2020 Example Corporation. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by "
        "any means without the prior written permission of the publisher.",
    ),
}

OTHER_TERMS: tuple[str, ...] = (
    "Licensed under the Example Community License, version 5.",
    "This work is licensed under the terms of the house license of the foundation.",
    "Released under our own license; see the file LICENSE for the terms.",
    "You may use this work under the terms of the license agreement that comes with it.",
    "Use of this software is subject to the end user license agreement.",
    "Licensed to members of the society under the conditions of its charter.",
    "Distributed under a license that permits use in schools only.",
    "This document is licensed under the Open Harbor License, version 1.2.",
    "Released under the Garden Public License.",
    "The software is provided under a commercial license.",
)

NO_TERMS: tuple[str, ...] = (
    "The driver showed a license and went on to the city.",
    "A fishing license costs ten crowns a year and is free for children.",
    "She studied at MIT and released her first record in the spring.",
    "The Apache are a people of the south west; the helicopter has their name.",
    "The general public was free to use the library until the later hours.",
    "The council granted permission to build the bridge under new conditions.",
    "Version 2 of the plan was published in the paper of the foundation.",
    "Copies of the letter were distributed to any person who asked.",
    "The eclipse was seen in the public garden, without charge.",
    "The software was sold with a printed guide and a warranty of two years.",
    "The source of the river lies above the village; its form is a narrow fall.",
    "All rights of way must be kept free of snow.",
    "He wrote a work on free trade and the terms of the treaty.",
    "The court required a written notice of the law by the end of the month.",
    "The license plate was found in the creek, with modification to its numbers.",
    "A creative mind is common among bakers, said the international report.",
    "The author waived the fee and dedicated the book to the teacher.",
    "Domain walls in the crystal were published as a note.",
    "Open the file, copy the list and sell the rest, provided that it is dry.",
    "The gnu is a large animal of the open plain.",
)
